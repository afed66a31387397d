"""BPE encoding and decoding: a minimal transducer holds the frequent words, unseen words are merged exactly."""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.automaton import Automaton, compile_words
from sedimenta.llm.common import local_copy, mapped, once, shipped, shipped_file, stored, texts_of

#: Words compiled into the transducer: a bound on driver memory only, the others are merged.
LEXICON_WORDS = 1 << 16
#: A word is frequent from so many occurrences on; keeps what tasks offer to the driver small.
LEAST_COUNT = 8
#: Chunks of text whose ids a worker remembers.
CACHE_CHUNKS = 500_000
_NONE = np.int32(2**31 - 1)

# White_Space of Unicode. str.split() also splits at U+001C to U+001F.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Encoder:
    """Encodes as a byte-level BPE with word ends: NFC, lower case, white space dropped."""

    def __init__(self, definition: str, lexicon: str | None = None, cache: int = CACHE_CHUNKS):
        with open(definition, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.last = np.array([vocab[x + suffix] for x in letters], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges] or [0], np.int32)
        self.pairs = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed([*enumerate(merges)])}
        self._table()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t.encode() for t, i in (vocab | self.special).items()}
        self.size = max(self.tokens, default=-1) + 1
        self.find_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", _SPACE.pattern[1:-2]))
        self.lexicon = Automaton(lexicon) if lexicon else None
        self.limit = cache
        self.known: dict[str, bytes] = {}

    def _table(self) -> None:
        """Open addressing for (left, right) -> rank, filled and searched a whole array at a time."""
        bits = 19
        while 1 << bits < 8 * len(self.pairs):
            bits += 1
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        ranks = np.array([*self.pairs.values()], np.int32)
        self.probes = 0
        at = self._home(keys)
        while len(keys):
            self.probes += 1
            empty = np.flatnonzero(self.slots[at] < 0)
            _, first = np.unique(at[empty], return_index=True)
            put = empty[first]
            self.slots[at[put]], self.ranks[at[put]] = keys[put], ranks[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, ranks, at = keys[rest], ranks[rest], (at[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the largest number for pairs that are never merged."""
        keys = left.astype(np.int64) << 32 | right
        at = self._home(keys)
        found = np.where(self.slots[at] == keys, self.ranks[at], _NONE)
        open_ = np.flatnonzero((found == _NONE) & (self.slots[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            hit = self.slots[at[open_]] == keys[open_]
            found[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (self.slots[at[open_]] >= 0)]
        return found

    # -- words ---------------------------------------------------------------------

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word by exact merging, as unsigned 32-bit integers; words of like length are merged together."""
        out = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > 48:
                out[i] = self.merge_one(word)
            elif word:
                by_width.setdefault((len(word) + 3) >> 2, []).append(i)
        for width, rows in by_width.items():
            for start in range(0, len(rows), 1 << 15):
                some = rows[start : start + (1 << 15)]
                for place, ids in self._merge_block([words[i] for i in some], 4 * width):
                    out[some[place]] = ids
        return out

    def _merge_block(self, words: list[bytes], width: int) -> Iterator[tuple[int, bytes]]:
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = self.inner[raw]
        ids[np.arange(n), length - 1] = self.last[raw[np.arange(n), length - 1]]
        columns = np.arange(width)
        rank = np.full((n, width), _NONE, np.int32)
        rank[:, :-1] = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        rank[columns >= (length - 1)[:, None]] = _NONE
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = np.arange(n)
        while len(rows):
            at = rank.argmin(axis=1)  # the leftmost of the lowest
            best = rank[np.arange(len(rows)), at]
            going = best != _NONE
            if not going.all():
                done.append((rows[~going], ids[~going], length[~going]))
                rows, ids, rank, length, at, best = (x[going] for x in (rows, ids, rank, length, at, best))
                if not len(rows):
                    break
            line = np.arange(len(rows))
            ids[line, at] = self.merged[best]
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, 1)
            rank = np.take_along_axis(rank, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            length = length - 1
            rank[line, length - 1] = _NONE
            right = np.flatnonzero(at < length - 1)
            rank[right, at[right]] = self.rank(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.rank(ids[left, at[left] - 1], ids[left, at[left]])
        for places, values, sizes in done:
            flat = values[columns < sizes[:, None]].astype("<u4").tobytes()
            ends = np.cumsum(sizes * 4).tolist()
            for place, start, end in zip(places.tolist(), [0, *ends], ends):
                yield place, flat[start:end]

    def merge_one(self, word: bytes) -> bytes:
        """A long word, with a heap of pairs and a linked list of symbols: n log n steps."""
        ids = [int(self.inner[b]) for b in word[:-1]] + [int(self.last[word[-1]])]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.pairs.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    # -- texts ---------------------------------------------------------------------

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # letter by letter, so a final sigma is not special
                return "".join(c.lower() for c in text)
        return text.lower()

    def chunks(self, text: str) -> list[str]:
        if _SEPARATORS.search(text):
            return [c for c in _SPACE.split(text) if c]
        return text.split()

    def words(self, chunk: str) -> list[bytes | int]:
        """The words of a chunk without white space; a special token is its id."""
        if "<" in chunk and self.find_special and self.find_special.search(chunk):
            out: list[bytes | int] = []
            for part in self.find_special.split(chunk):
                out += [self.special[part]] if part in self.special else self._plain(part)
            return out
        return self._plain(chunk)

    def _plain(self, chunk: str) -> list[bytes | int]:
        text = self.normal(chunk)
        if text.isalpha():
            return [text.encode()]
        return [p.encode() for p in self.pieces.findall(text)]

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """The ids of the chunks."""
        parts: dict[str, list[bytes | int]] = {}
        single: dict[str, bytes] = {}
        for c in chunks:
            if c.isascii():
                if c.isalpha():
                    single[c] = c.lower().encode()
                elif c[:-1].isalpha():  # a word and one sign or figure
                    parts[c] = [c[:-1].lower().encode(), c[-1].encode()]
                else:
                    parts[c] = self.words(c)
            elif (w := self.normal(c)).isalpha():
                single[c] = w.encode()
            else:
                parts[c] = self.words(c)
        fresh = {w for ws in parts.values() for w in ws if isinstance(w, bytes)}
        fresh.update(single.values())
        words = [*fresh]
        ids: dict[bytes | int, bytes] = {i: i.to_bytes(4, "little") for i in self.special.values()}
        if self.lexicon:
            ranks = self.lexicon.ranks(words).tolist()
            ids |= {w: self.lexicon.ids(r).tobytes() for w, r in zip(words, ranks) if r >= 0}
            words = [w for w, r in zip(words, ranks) if r < 0]
        ids |= zip(words, self.merge_words(words))
        return {c: ids[w] for c, w in single.items()} | {c: b"".join([ids[w] for w in ws]) for c, ws in parts.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        # millions of short-lived lists and no cycles: the collector would walk them over and over
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(t) for t in texts]
        missing = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            # the half that was learned first stays: frequent chunks come early
            self.known = dict(islice(self.known.items(), self.limit // 2))
            missing = set(chain.from_iterable(split)).difference(self.known)
        if missing:
            self.known |= self.learn(missing)
        return [b"".join(map(self.known.__getitem__, cs)) for cs in split]

    def decode(self, ids: bytes) -> bytes:
        """The tokens joined by blanks, in UTF-8: what a tokenizer without a decoder gives."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoder(definition: str, lexicon: str | None = None, cache: int = CACHE_CHUNKS) -> Encoder:
    """The worker's encoder of shipped files."""
    return once(f"bpe {definition} {lexicon}", lambda: Encoder(local_copy(definition), local_copy(lexicon) if lexicon else None, cache))


def word_counts(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """`(word binary, n long)` over all texts; each block is counted before anything is shuffled."""
    from collections import Counter

    def work(batch) -> dict:
        own, count = encoder(definition), Counter()
        for t in texts_of(batch, text):
            count.update(own.chunks(t))
        words: Counter = Counter()
        for chunk, n in count.items():
            for w in own.words(chunk):
                if isinstance(w, bytes):
                    words[w] += n
        return {"word": [*words], "n": [*words.values()]}

    return mapped(docs.select(text), "word binary, n long", work, text).groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, definition: str, words: int = LEXICON_WORDS, text: str = "text") -> list[bytes]:
    """At most `words` frequent words, most frequent first, ties in byte order; counted over the whole table.

    The least count that so many words reach is found from a histogram of the counts' leading bits: only the words
    that stand above it come to the driver, never more than `words`, however many tasks there are.
    """
    counts = stored(word_counts(docs, definition, text).filter(F.col("n") >= LEAST_COUNT), "words")
    # a count's power of two and the next six bits: within one step counts differ by under two per cent
    shift = F.greatest(F.floor(F.log2("n")).cast("int") - 6, F.lit(0))
    step = F.expr("shiftright(n, s) << s")
    steps = counts.withColumn("s", shift).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"))
    least, total = None, 0
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += r["words"]
        if total > words:
            break
        least = r["step"]
    if least is None:
        return []
    rows = counts.filter(F.col("n") >= least).collect()
    return [bytes(r["word"]) for r in sorted(rows, key=lambda r: (-r["n"], bytes(r["word"])))]


def compile_lexicon(spark: SparkSession, docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, text: str = "text") -> tuple[str, str]:
    """Ships the tokenizer and the transducer of the corpus's frequent words; returns their names for `encode`."""
    definition = shipped_file(spark, tokenizer)
    common = frequent_words(docs, definition, words, text)
    own = Encoder(tokenizer)
    return definition, shipped(spark, "lexicon", compile_words({w: np.frombuffer(x, "<u4").tolist() for w, x in zip(common, own.merge_words(common))}))


def encode(docs: DataFrame, names: tuple[str, str | None], identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, ids array<int>)`, one row per input row. A NULL or empty text has no ids; other columns are left out."""
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch) -> dict:
        ids = encoder(*names).encode(texts_of(batch, text))
        return {identity: batch.column(identity), "ids": [np.frombuffer(x, "<i4") for x in ids]}

    return mapped(docs.select(identity, text), f"`{identity}` {kind}, ids array<int>", work, text)


def decode(encoded: DataFrame, definition: str, identity: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`(identity, text string)` from id arrays; NULL ids give the empty text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = encoded.schema[identity].dataType.simpleString()
    schema = f"`{identity}` {kind}, text string"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = encoder(definition)
            lists = [np.asarray([] if x is None else x, "<u4").tobytes() for x in batch.column(ids).to_pylist()]
            yield pa.record_batch([batch.column(identity), pa.array([own.decode(x).decode() for x in lists], pa.string())], schema=arrow)

    return encoded.select(identity, ids).mapInArrow(run, schema)


def digests(docs: DataFrame, names: tuple[str, str | None], identity: str = "doc_id", text: str = "text", cache: int = CACHE_CHUNKS) -> DataFrame:
    """`(identity, n_tokens, ids_sha256, decoded_sha256)`: encodes, decodes the ids again and hashes both.

    One row per input row: NULL and empty texts have no ids, repeated rows come again, other columns are left out. `cache` is
    the number of chunks a worker remembers; ids do not depend on it.
    """
    from hashlib import sha256

    kind = docs.schema[identity].dataType.simpleString()

    def work(batch) -> dict:
        own = encoder(*names, cache)
        ids = own.encode(texts_of(batch, text))
        return {
            identity: batch.column(identity),
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [sha256(own.decode(x)).hexdigest() for x in ids],
        }

    schema = f"`{identity}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(docs.select(identity, text), schema, work, text)
