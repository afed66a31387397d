"""Token counts of a unigram tokenizer without making tokens: Aho-Corasick finds the vocabulary's pieces, and a
Viterbi pass carries the best score and the number of pieces, with the tokenizer's rules for ties.

Pieces that end at a place are met longest first, and a later one wins only with a strictly higher score: of equal
paths the one whose last piece begins first is kept. A letter without a piece of its own may be unknown, at ten below the
lowest score; unknown letters become their bytes where the vocabulary has all bytes, else a run of them is one token.
"""

from __future__ import annotations

import json

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm.common import local_copy, mapped, once, shipped, texts_of

BLANK, PENALTY = "▁", 10.0
CACHE_CHUNKS = 500_000


def vocabulary(model: str) -> list[tuple[str, float]]:
    """The pieces and scores of a model file."""
    own = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(own.id_to_piece(i), own.get_score(i)) for i in range(own.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        scores = {}
        for piece, score in pieces:
            if piece:
                scores[piece] = score  # of repeated pieces the last counts
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.empty = not scores
        self.unknown = min((s for _, s in pieces), default=0.0) - PENALTY
        self.single = {p for p in scores if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.known: dict[str, int] = {}

    def count(self, chunk: str) -> int:
        """Pieces of the best path through a chunk."""
        n = len(chunk)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if not self.empty:
            for end, piece in self.automaton.iter(chunk):
                ends[end].append(piece)
        score, pieces, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            best = None
            for length, own in ends[end]:
                total = score[end + 1 - length] + own
                if best is None or total > best:
                    best, start = total, end + 1 - length
            if chunk[end] not in self.single:
                total = score[end] + self.unknown
                if best is None or total > best:
                    score[end + 1], unknown[end + 1] = total, True
                    more = len(chunk[end].encode()) if self.bytes else int(not unknown[end])
                    pieces[end + 1] = pieces[end] + more
                    continue
            score[end + 1], pieces[end + 1] = best, pieces[start] + 1
        return pieces[n]

    def total(self, text: str) -> int:
        """Blanks are marks that begin chunks; a text that begins otherwise gets one."""
        if not text:
            return 0
        marked = text.replace(" ", BLANK)
        chunks = marked.split(BLANK)
        if marked[0] == BLANK:
            chunks = chunks[1:]
        known = self.known
        found = [*map(known.get, chunks)]
        if None in found:
            if len(known) > CACHE_CHUNKS:
                known.clear()
            for c in set(chunks):
                if c not in known:
                    known[c] = self.count(BLANK + c)
            found = [known[c] for c in chunks]
        return sum(found)


def ship(spark: SparkSession, pieces: list[tuple[str, float]]) -> str:
    return shipped(spark, "unigram", json.dumps(pieces).encode())


def _loaded(name: str) -> Counter:
    def load() -> Counter:
        with open(local_copy(name), encoding="utf-8") as file:
            return Counter([(p, s) for p, s in json.load(file)])

    return once(f"unigram {name}", load)


def token_counts(docs: DataFrame, pieces: str, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, n_tokens)` of every row, from its whole text; NULL and empty texts have 0 tokens. Other columns are left out."""
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch) -> dict:
        own = _loaded(pieces)
        return {identity: batch.column(identity), "n_tokens": [own.total(t) for t in texts_of(batch, text)]}

    return mapped(docs.select(identity, text), f"`{identity}` {kind}, n_tokens long", work, text)
