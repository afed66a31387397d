"""Mixing: targets against a plain version, sums within the shortest document, expectations, reruns, edge cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sedimenta.llm import mixing

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return capped
        each = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = {s: 2.0 * sizes[s] for s in free if weight[s] * each > 2 * sizes[s]}
        if not over:
            return capped | {s: weight[s] * each for s in free}
        capped |= over


def words(text) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def sample(many: int = 400) -> list[tuple]:
    rows = [(i, f"s{i % 7}" if i % 3 else "big", "w " * (1 + (i * 7919) % 97)) for i in range(many)]
    return rows + [(9000, None, "a b\tc\x0bd e"), (9001, None, None), (9002, "empty", ""), (9003, "empty", " \n"), (None, "s1", "x y z"), (9004, "long", "word " * 20_000)]


def result(spark, rows, **options) -> list[tuple]:
    return [tuple(r) for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), **options).collect()]


def check(rows, out) -> None:
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += words(t)
    want = plain_targets(sizes)
    by_id = defaultdict(list)
    for i, s, t in rows:
        by_id[i].append((words(t), sizes[s], round(want[s], 6)))
    assert Counter((i, n, m, round(t, 6)) for i, n, m, t, _ in out) == Counter((i, *x) for i, xs in by_id.items() for x in xs)
    assert all(k in (0, n, 2 * n) for _, n, _, _, k in out)
    taken, least = defaultdict(int), defaultdict(lambda: 10**9)
    for _, n, m, t, k in out:
        taken[m, t] += k
        least[m, t] = max(least[m, t], n) if least[m, t] < 10**9 else n
    for (m, t), k in taken.items():
        assert abs(k - t) <= least[m, t]  # never further off than one document


def test_targets_and_sums(spark):
    rows = sample()
    check(rows, result(spark, rows))


def test_many_levels_of_the_tree(spark):
    rows = sample(600)
    check(rows, result(spark, rows, group=4))


def test_sums_are_near_where_there_are_short_documents(spark):
    rows = [(i, "ab"[i % 2], "w " * (1 + (i * 7919) % 500)) for i in range(3000)]
    out = result(spark, rows, group=64)
    for target in {t for *_, t, _ in out}:
        assert abs(sum(k for *_, t, k in out if t == target) - target) <= 100  # documents have 250 words on average


def test_expectations_stay(spark):
    rows = [(i, "a" if i < 40 else "b", "w " * (1 + i % 9)) for i in range(80)]
    total, runs = defaultdict(float), 60
    for seed in range(runs):
        for i, n, m, t, k in result(spark, rows[:12] + rows[40:52], seed=seed, group=6) if seed < 8 else []:
            total[i] += k / n - t / m
    assert abs(sum(total.values())) < 24 * 8 * 0.15
    # the rounding itself, over many seeds
    units = [(f"d{i}", 1 + i % 5, 0.3 * (1 + i % 5)) for i in range(9)]
    hits, tries = Counter(), 6000
    for seed in range(tries):
        copies, left = mixing.settle(units, seed)
        assert len(copies) + (left is not None) == len(units)
        mass = sum(units[i][1] * c for i, c in copies.items()) + (left[1] if left else 0)
        assert abs(mass - sum(u[2] for u in units)) < 1e-9
        for i, c in copies.items():
            hits[i] += c
        if left:
            hits[left[0]] += left[1] / units[left[0]][1]
    assert all(abs(hits[i] / tries - 0.3) < 0.03 for i in range(9))


def test_reruns_agree_however_rows_are_dealt(spark):
    rows = sample() + [(1, "s1", "a b c")] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    one, two = (Counter(map(tuple, mixing.mix(d).collect())) for d in (df.coalesce(1), df.repartition(7).orderBy(F.desc("doc_id"))))
    assert one == two and sum(one.values()) == len(rows)


def test_repeats_clashing_columns_and_empty(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 4)
    rows = [(1, "a", "x y")] * 30 + [(2, "b", "x")] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "rows", "_part", "_n", "_s", "place", "target", "node", "copies", "many", "last"):
        df = df.withColumn(name, F.lit("clash"))
    check(rows, [tuple(r) for r in mixing.mix(df).collect()])
    assert result(spark, []) == []
    assert [r[1:] for r in result(spark, [(1, "a", None)])] == [(0, 0, 0.0, 0)]
