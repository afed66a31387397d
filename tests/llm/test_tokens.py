"""The transducer, exact merging and token files against the tokenizers library and plain arithmetic."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sedimenta.llm import bpe, token_files
from sedimenta.llm.automaton import Automaton, compile_words
from sedimenta.llm.common import shipped_file

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", None, "don't I'LL we're", "ΣΑΣ ΟΔΟΣ Σ", "cafe\u0301 é İstanbul \x1c a\x1fb \x85\u00a0\u3000x", "a<|endoftext|>b <|startoftext|>", "1234 ½ ٣",
    "x" * 100 + "é" * 30, "nai\u0308ve\u200bzero", "日本語 テキスト", "😀😀 👨‍👩‍👧", "ﬁ ǅ ß ẞ", "<|EndOfText|> <|", "'s't're'x", "Ω\u212b", "힣 한",
    "The the THE", "same", "same", "word " * 30_000, "y" * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i if i else None, t, "de", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def test_words_merge_as_the_library_does(library):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(1, 70))) for _ in range(3000)]
    own = bpe.Encoder(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in own.merge_words([w.encode() for w in words])]
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_automaton_is_minimal_and_exact(tmp_path):
    entries = {w.encode(): [i, 7] for i, w in enumerate("a ab abc b bc xing ing sing king".split())}
    (tmp_path / "lexicon").write_bytes(compile_words(entries))
    automaton = Automaton(str(tmp_path / "lexicon"))
    ranks = automaton.ranks([*entries, b"", b"kin", b"kings", b"zz"])
    assert [automaton.ids(r).tolist() for r in ranks[: len(entries)]] == [*entries.values()]
    assert (ranks[len(entries) :] == -1).all()
    # "ing" is stored once for xing, sing, king; the final states of all words are one
    assert len(automaton.arrays["final"]) == 7
    (tmp_path / "none").write_bytes(compile_words({}))
    assert Automaton(str(tmp_path / "none")).ranks([b"a"]).tolist() == [-1]


@pytest.mark.parametrize("words", [0, 5, 1 << 16])
def test_digests_equal_the_library(spark, library, words):
    table = docs(spark)
    names = bpe.compile_lexicon(spark, table, PATH, words)
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(table, names).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw, text = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode()
        assert got[i or None] == (len(ids), sha256(raw).hexdigest(), sha256(text).hexdigest())


def test_encode_and_decode_frames(spark, library):
    table = docs(spark)
    names = bpe.compile_lexicon(spark, table, PATH, 100)
    encoded = bpe.encode(table, names)
    texts = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, names[0]).collect()}
    for i, t in enumerate(TEXTS):
        assert texts[i or None] == library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)


def test_small_cache_gives_the_same_ids(library):
    own = bpe.Encoder(PATH, cache=3)
    for text in ("one two three four five", "six one two", "one"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_elias_fano_selects_every_value():
    rnd = np.random.default_rng(1)
    for values in ([], [0], [0, 0, 0], [5], [2**40], np.cumsum(rnd.integers(0, 9, 5000)), np.sort(rnd.integers(0, 2**45, 3000)), [0] * 600 + [10**9]):
        values = np.asarray(values, np.int64)
        packed = token_files.EliasFano.of(values).pack()
        again, size = token_files.EliasFano.unpack(memoryview(packed))
        assert size == len(packed)
        order = rnd.permutation(len(values))
        assert (again.get(order) == values[order]).all()
    many = np.cumsum(rnd.integers(0, 2000, 100_000))
    assert len(token_files.EliasFano.of(many).pack()) * 8 / len(many) < 2 + np.log2(2000) + 0.5


@pytest.mark.parametrize("shard_ids", [1, 50, 1 << 20])
def test_token_files(spark, library, tmp_path, shard_ids):
    texts = [t for t in TEXTS if t is None or len(t) < 1000] * 3
    rows = [(d, t) for d, t in zip([None, 9, -4, 2**40, 7, 7, *range(100, 100 + len(texts))], texts)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    manifest = token_files.write_shards(table, str(tmp_path / "shards"), shipped_file(spark, PATH), 1, shard_ids=shard_ids)
    got = sorted((tuple(r) for r in token_files.read_shards(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    want = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.setdefault(d, []).append((len(ids), crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for d, start, n, crc in got:
        assert start == at and (n, crc) in want[d]
        at += n


def test_empty_tables(spark, tmp_path):
    table = docs(spark, [])
    assert token_files.read_shards(token_files.write_shards(table, str(tmp_path / "none"), shipped_file(spark, PATH))).collect() == []
    assert bpe.digests(table, bpe.compile_lexicon(spark, table, PATH)).collect() == []


def test_a_full_cache_keeps_the_chunks_learned_first(library, monkeypatch):
    often = [f"often{i}" for i in range(30)]
    blocks = [[" ".join([*often, *(f"rare{b}x{i}" for i in range(40))])] * 2 for b in range(12)]
    own, learned = bpe.Encoder(PATH, cache=100), []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda chunks: learned.extend(chunks) or learn(chunks))
    for texts in [[" ".join(often)], *blocks, [" ".join(f"wide{i}" for i in range(500))], *blocks[:1]]:
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.known) <= 50 + max(50, len(set(texts[0].split())))
    assert all(learned.count(c) == 1 for c in often)
