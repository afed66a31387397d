"""Exact top-k against all pairs: ties, unusable vectors, small blocks, rows of one id."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sedimenta.llm import topk


def brute(rows, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, score int, rank string").repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id % 20 = 0"), k).collect())


@pytest.mark.parametrize("kind", ["plain", "ties", "clusters"])
def test_equals_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 90)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 4)
    rnd = np.random.default_rng(7)
    v = rnd.standard_normal((300, 16)) / 4
    if kind == "ties":
        v = rnd.integers(-1, 2, (300, 16)) / 8
    if kind == "clusters":
        v = v[rnd.integers(0, 6, 300)] + rnd.standard_normal((300, 16)) / 100
    rows = [(i - 40, [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    assert run(spark, rows) == brute(rows, 5)


def test_stopping_early_drops_no_member():
    rnd = np.random.default_rng(8)
    matrix = rnd.integers(-30, 30, (4000, 32))
    matrix[:50] = matrix[0] + rnd.integers(-2, 2, (50, 32))
    segments = topk.Segments(np.arange(4000), matrix)
    for q in (0, 7, 400):
        ids, scores = segments.top(q, matrix[q], 20)
        want = sorted((-int(s), i) for i, s in enumerate(matrix @ matrix[q]) if i != q)[:20]
        assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
    left = segments._possible(matrix[0], np.arange(1, 4000), 20)
    assert len(left) < 1000


def test_unusable_vectors_short_vectors_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, None), (60, [nan, 1.0]), (1, [inf, 0.0]), (2, [None, 1.0]), (3, []), (4, [-1.0, -0.01]), (4, [-1.0, -0.01]), (5, [0.5, 0.5, 9.0]), (None, [1.0, 1.0]), (0, [3.0, 3.0])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


@pytest.mark.parametrize("far", [1e15, 1e30, 3e38])
def test_components_too_large_for_exact_scores_end_the_query_with_a_reason(spark, far):
    rows = spark.createDataFrame([(20, [far, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit"):
        topk.top_k(rows, rows.filter("vec_id % 20 = 0")).collect()


def test_large_components_that_fit_are_exact(spark):
    rows = spark.createDataFrame([(20, [3e7, -2e7]), (1, [1e7, 3e7]), (2, [-3e7, 0.5])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(rows, rows.filter("vec_id % 20 = 0")).collect()]
    v = {1: (10**7 * 64, 3 * 10**7 * 64), 2: (-3 * 10**7 * 64, 32)}
    q = (3 * 10**7 * 64, -2 * 10**7 * 64)
    assert sorted(got, key=lambda x: -x[1]) == sorted(((i, q[0] * x + q[1] * y) for i, (x, y) in v.items()), key=lambda x: -x[1])


@pytest.mark.parametrize("spread", [40, 3000, 1 << 28])
def test_a_group_of_queries_leaves_few_rows_to_score(spread):
    rnd = np.random.default_rng(9)
    matrix = rnd.integers(-spread, spread, (3000, 24))
    matrix[1500:1530] = matrix[7]
    ids = rnd.integers(0, 2500, 3000)  # some repeat
    segments = topk.Segments(ids, matrix)
    asked = np.array([*range(0, 300), -1])
    found = [*segments.tops(ids[asked], matrix[asked], 20)]
    for q, (names, scores) in zip(asked.tolist(), found):
        want = sorted((-int(s), int(i)) for i, s in zip(ids, matrix @ matrix[q]) if i != ids[q])[:20]
        assert [(-s, i) for s, i in zip(scores.tolist(), names.tolist())] == want
    left = segments._possible_of(matrix[:100], [np.flatnonzero(ids == ids[q]) for q in range(100)], 20)
    # random vectors leave no gap to stop early in, so what postings round away must not keep rows in
    assert max(map(len, left)) <= (60 if spread == 40 else 300)
    assert len(segments.dims) <= 24 * 2 * topk.LEVELS
