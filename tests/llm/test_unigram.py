"""Counts against the tokenizers library's unigram model with the same pieces and scores."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from sedimenta.llm import unigram

PIECES = unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = ["", " ", "  ", "a", " a", "a ", "Hello  world", "tabs\tand\nlines\n\n", "日本語 テキスト", "😀 é́ \x00\x01", "<0x0A> <s> <unk>", "▁x▁▁y", "e" * 3000, "the " * 3000]


def library(pieces, fallback):
    own = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    own.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return own


def texts(seed, letters, n=300):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("letters", ["abcdeinorst  ", "aàéß€日😀\n\t <>0x"])
def test_counts_equal_the_library(letters):
    own, lib = unigram.Counter(PIECES), library(PIECES, True)
    for t in TEXTS + texts(1, letters):
        assert own.total(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_ties_and_runs_of_unknown_letters():
    rnd = random.Random(2)
    for seed in range(20):
        # few scores, so that many paths are equal; letters without a piece
        pieces = [("<unk>", 0.0), ("▁", -1.0)] + [(p, -float(rnd.randrange(1, 4))) for p in sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4))) for _ in range(12)})]
        own, lib = unigram.Counter(pieces), library(pieces, False)
        for t in texts(seed, "abcxy ", 100):
            assert own.total(t) == len(lib.encode(t, add_special_tokens=False).ids), (pieces, t)


def test_frame_with_nulls_and_clashing_columns(spark):
    rows = [(1, None, 9), (None, "a b", 9), (2, "", 9), (3, "a b", 9), (3, "a b", 9)]
    out = unigram.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), unigram.ship(spark, PIECES))
    assert [tuple(r) for r in out.collect()] == [(1, 0), (None, 2), (2, 0), (3, 2), (3, 2)]
    assert unigram.token_counts(spark.createDataFrame([], "doc_id long, text string"), unigram.ship(spark, PIECES)).collect() == []
