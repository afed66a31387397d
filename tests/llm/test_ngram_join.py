"""The Jaccard join against all pairs, the bounds it rests on, and components against a plain search."""

from __future__ import annotations

import gc
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import common, ngram_join
from sedimenta.llm.components import components


def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, num=90, den=100):
    sets = [shingles(t) for _, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b, x, y = sets[j], rows[i][0], rows[j][0]
            if a and b and x is not None and y is not None and den * len(a & b) >= num * len(a | b):
                x, y = root(x), root(y)
                up[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d)) for (d, _), s in zip(rows, sets)), key=str)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(n):
        if rows and rnd.random() < 0.6:
            base = rnd.choice(rows)[1].split()
            for _ in range(rnd.randrange(0, 4)):
                k = rnd.randrange(len(base) + 1)
                base[k : k + rnd.randrange(2)] = [rnd.choice(words)] * rnd.randrange(2)
            rows.append((len(rows), " ".join(base) or "x"))
        else:
            rows.append((len(rows), " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 11, 12, 13, 20, 40, 100, 300])))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_join.join_components(df).collect()), key=str)
    assert got == brute(rows)


def test_nulls_ties_separators_and_clashing_columns(spark):
    text = "The quick brown\tfox\x0bjumps over the lazy\x1fdog"
    rows = [(5, text), (3, text.upper()), (9, text.replace(" ", "\n")), (None, text), (1, None), (2, ""), (4, " \n "), (6, "one"), (7, "ONE"), (8, "É é"), (10, "é é"), (11, "one two"), (12, "one\xa0two"), (11, "one two"), (13, "alpha"), (13, "beta"), (14, "beta"), (15, "alpha")]
    df = spark.createDataFrame([(*r, 1, b"n", [1]) for r in rows], "doc_id long, text string, component_id int, node binary, keys array<int>")
    got = sorted((tuple(r) for r in ngram_join.join_components(df).collect()), key=str)
    want = brute([r for r in rows if r[0] != 13])
    want = [(d, n, 13 if d in (14, 15) else c) for d, n, c in want] + [(13, 1, 13)] * 2
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert ngram_join.join_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_cluster_is_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 7)
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(60):
        words = list(words)
        words[rnd.randrange(80)] = f"v{i}"
        rows.append((i * 3, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in ngram_join.join_components(df).collect()), key=str) == brute(rows)


def test_common_passages_do_not_join_documents():
    rnd, rule = np.random.default_rng(9), ngram_join.Rule(80, 100)
    passage = rnd.integers(0, 2**63, 30, dtype=np.uint64)
    sets = [np.union1d(passage, rnd.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(300)]
    keys = np.concatenate([np.unique(rule.keys(s, np.sort(passage))) for s in sets])
    assert len(np.unique(keys)) == len(keys) < len(np.concatenate([rule.keys(s) for s in sets]))


def test_linked_sets_share_a_key():
    rnd = np.random.default_rng(5)
    for num, den in ((90, 100), (80, 100), (95, 100)):
        rule = ngram_join.Rule(num, den)
        for size in [*range(1, 60), 100, 333, 1000]:
            a = np.unique(rnd.integers(0, 2**63, size, dtype=np.uint64))
            # as different as a link allows, in sizes alike and unlike
            for added in range(0, 2 + size // 8):
                for removed in {0, added, added // 2}:
                    if removed < size:
                        b = np.unique(np.concatenate([a[removed:], rnd.integers(0, 2**63, added, dtype=np.uint64)]))
                        both = len(np.intersect1d(a, b))
                        if den * both >= num * (len(a) + len(b) - both) and not np.array_equal(a, b):
                            assert len(np.intersect1d(rule.keys(a), rule.keys(b))), (num, size, added, removed)
                            # whatever counts as common, from a few shingles to all
                            for share in (0.1, 0.5, 0.9, 1.0):
                                both_sets = np.union1d(a, b)
                                common = np.sort(rnd.choice(both_sets, int(share * len(both_sets)), replace=False))
                                assert len(np.intersect1d(rule.keys(a, common), rule.keys(b, common))), (num, size, added, removed, share)


def test_tree_keeps_every_linked_pair():
    rnd, rule = np.random.default_rng(6), ngram_join.Rule()
    base = rnd.integers(0, 2**63, 200, dtype=np.uint64)
    sets = []
    for _ in range(150):
        s = base.copy()
        s[rnd.integers(0, 200, rnd.integers(0, 12))] = rnd.integers(0, 2**63, dtype=np.uint64)
        sets.append(np.unique(s[: 200 - rnd.integers(0, 30)]))
    sizes = np.array([len(s) for s in sets])
    points = np.array([np.bincount((s & np.uint64(63)).astype(int), minlength=64) for s in sets], np.int32)
    tree = ngram_join.CountTree(points, sizes)
    for i, s in enumerate(sets):
        near = set(tree.near(points[i], len(s), rule).tolist())
        for j, t in enumerate(sets):
            both = len(np.intersect1d(s, t))
            if 100 * both >= 90 * (len(s) + len(t) - both):
                assert j in near


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    order = list(range(1, 300))
    rnd.shuffle(order)
    links = [(a, b) for a, b in zip(order, order[1:])] + [(1000, 1000 + i) for i in range(50)] + [(2000, 2000), (None, 3), (5, None), (3001, 3000), (3000, 3001)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 1 for i in range(1, 300)} | {1000 + i: 1000 for i in range(50)} | {3000: 3000, 3001: 3000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def components_by_search(links):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return sorted((x, root(x)) for x in up)


def test_rounds_of_components_run_few_tasks(spark):
    rnd = random.Random(5)
    order = list(range(600))
    rnd.shuffle(order)
    links = [*zip(order, order[1:]), *[(1000, 1001 + i) for i in range(300)], *[(3000 + i, 3001 + i) for i in range(300)]]
    links += [(rnd.randrange(5000, 5900), rnd.randrange(5000, 5900)) for _ in range(500)] + [(None, 1), (2, None), (7000, 7000)]
    rnd.shuffle(links)
    df, parts = spark.createDataFrame(links, "a long, b long").repartition(40), 40
    sc = spark.sparkContext
    sc.setJobGroup("rounds", "components")
    try:
        got = sorted(map(tuple, components(df).collect()))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == components_by_search(links)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds]
    # each task leaves state with the driver: reading twice, then some stages of four partitions for each of a few rounds
    assert sum(s.numCompletedTasks for s in stages if s) <= 2 * parts + 60


def test_links_made_by_python_are_stored_before_python_contracts_them(spark, monkeypatch):
    from sedimenta.llm import components as module

    plans, plain = [], module._contracted
    monkeypatch.setattr(module, "_contracted", lambda links: plans.append(links._jdf.queryExecution().toString()) or plain(links))
    made = spark.createDataFrame([(2, 1), (3, 2)], "a long, b long").mapInArrow(lambda batches: batches, "a long, b long")
    assert sorted(map(tuple, components(made).collect())) == [(1, 1), (2, 1), (3, 1)]
    assert plans and not any("InArrow" in p for p in plans)


def test_components_of_bytes_take_the_least_in_byte_order(spark):
    links = [(b"\xff", b"\x7f"), (b"\x7f\x00", b"\x7f"), (b"", b"\xfe"), (b"\xfe", b"\x80")]
    df = spark.createDataFrame(links, "a binary, b binary").repartition(4)
    assert sorted((bytes(x), bytes(y)) for x, y in components(df).collect()) == components_by_search(links)


def test_row_without_an_id_before_near_copies(spark):
    words = [f"w{i}" for i in range(200)]
    text, near = " ".join(words), " ".join([*words[:100], "other", *words[101:]])
    rows = [(None, text), (5, text), (6, near), (None, near), (7, "apart from all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((tuple(r) for r in ngram_join.join_components(df).collect()), key=str) == brute(rows)
    kept = ngram_join.one_of_each(df, 3, 90, 100).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(None, text), (None, near), (5, text), (7, "apart from all")], key=str)


def test_packed_keys_come_back_and_links_of_a_task_are_kept():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 1 << 63, 5, dtype=np.int64)
    meetings = ngram_join.Meetings(3, 256)
    given: dict[int, set[int]] = {}
    for ordinal in range(300):
        keys = np.concatenate([rng.integers(-(1 << 63), (1 << 63) - 1, 40, dtype=np.int64), shared[: ordinal % 6]])
        meetings.add(ordinal, keys)
        for k in (keys.view(np.uint64) >> np.uint64(64 - ngram_join.KEY_BITS)).tolist():
            given.setdefault(k, set()).add((3 << 31) + ordinal)
    links, blobs = meetings.pack()
    back: dict[int, int] = {}
    for part, raw in blobs:
        keys, marks = ngram_join.Meetings.unpack(raw, ngram_join.KEY_BITS - 8)
        assert all(k >> (ngram_join.KEY_BITS - 8) == part for k in keys.tolist())
        back |= zip(keys.tolist(), marks.tolist())
    assert back == {k: min(m) for k, m in given.items()}
    assert {(a, b) for a, b in links} == {(a, min(m)) for m in given.values() for a in m if a != min(m)}
    assert ngram_join.Meetings(0, 256).pack() == ([], [])


def test_columns_named_like_inner_ones_stay_as_they_are(spark):
    same = "one two three four five six seven eight nine ten"
    rows = [(1, same), (2, same), (3, "another text that shares nothing at all with it"), (None, same)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_at", "_slot", "_bits", "_word", "_gone", "at", "word", "seen", "bits", "mark", "gone", "node"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    got = {r["doc_id"]: r.asDict() for r in ngram_join.one_of_each(df, 3, 90, 100).collect()}
    assert set(got) == {1, 3, None}
    assert all(r[c] == f"own {c}" for r in got.values() for c in df.columns[2:])


def test_finished_steps_leave_the_drivers_heap(spark, monkeypatch):
    """A step that is stored, and one whose keys are written, has the driver collect what is garbage once its heap is large."""
    lang = spark.sparkContext._jvm.java.lang

    def left(step) -> bool:
        ref = lang.ref.WeakReference(lang.Object())
        gc.collect()
        time.sleep(1)  # until the JVM knows that nothing here holds the object
        step()
        return ref.get() is not None

    docs = spark.createDataFrame([(i, f"some words of text {i % 3} and more of them") for i in range(20)], "doc_id long, text string")
    monkeypatch.setattr(common, "HEAP_SHARE", 0)
    assert not left(lambda: common.stored(docs, "docs"))
    assert not left(lambda: common.shipped(spark, "file", b"content"))
    assert not left(lambda: ngram_join.join_components(docs, words=3))
    monkeypatch.setattr(common, "HEAP_SHARE", 2)
    calls: list = []
    monkeypatch.setattr(ngram_join, "tidy", calls.append)
    ngram_join.join_components(docs, words=3)
    assert calls
