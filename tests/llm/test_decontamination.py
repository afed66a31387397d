"""Decontamination: planted leaks and paraphrases are found, clean texts left alone; the sketch against a full SVD."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sedimenta.llm import decontamination as d


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence_equals_dynamic_programming():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.choice("abcdef") for _ in range(rnd.randrange(n))] for n in (70, 90))
        assert d.common_words(a, b) == brute_common(a, b)


def test_nystrom_finds_the_leading_subspace():
    rnd = np.random.default_rng(1)
    a = rnd.standard_normal((500, 8)) @ rnd.standard_normal((8, 60)) + 0.01 * rnd.standard_normal((500, 60))
    test = rnd.standard_normal((60, 20))
    basis = d.right_singular_vectors(a.T @ (a @ test), test, 8)
    right = np.linalg.svd(a, full_matrices=False)[2][:8]
    assert np.allclose(np.linalg.svd(right @ basis)[1], 1, atol=1e-3)


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(4000)]
    common = words[:40]
    draw = lambda n: [rnd.choice(common) if rnd.random() < 0.4 else rnd.choice(words) for _ in range(n)]
    items = [(i, draw(rnd.randrange(20, 50))) for i in range(30)]
    docs, want = [], set()
    for k in range(300):
        text = draw(rnd.randrange(1, 400))
        if k % 5 == 0:
            i, item = items[k % 30]
            item = list(item)
            if k % 2:  # a paraphrase: every sixth word is another
                item[::6] = draw(len(item[::6]))
            at = rnd.randrange(len(text) + 1)
            text = text[:at] + [w.upper() + "," for w in item] + text[at:]
            want.add((k, i))
        docs.append((k, " ".join(text)))
    return docs, [(i, " ".join(t) + ".") for i, t in items], want


def test_planted_leaks_are_found_and_nothing_else(spark, planted):
    docs, items, want = planted
    found = d.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_more_items_than_a_pass_takes(spark, planted, monkeypatch):
    monkeypatch.setattr(d, "ITEMS_A_PASS", 24)
    docs, items, want = planted
    found = d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_nulls_repeats_long_texts_and_clashing_columns(spark, planted):
    docs, items, _ = planted
    leak = items[0][1]
    rows = [(1, leak), (1, leak), (None, leak), (2, None), (3, ""), (4, "filler " * 50_000 + leak), (5, "clean")] + [(k + 10, t) for k, t in docs[1:5]]
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, item_id int, codes string")
    bench = spark.createDataFrame([(*r, 1) for r in [*items, (None, leak), (99, None), (98, "")]], "item_id long, text string, doc_id int")
    assert sorted(r["doc_id"] for r in d.leaks(table, bench).collect()) == [1, 4]
    kept = d.keep_clean(table, bench)
    assert kept.columns == table.columns
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].dropna().tolist()) == [2, 3, 5, 11, 12, 13, 14] and kept.filter("doc_id IS NULL").count() == 1


def test_empty_tables(spark, planted):
    docs, items, _ = planted
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(no_docs, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert d.leaks(spark.createDataFrame(docs[:3], "doc_id long, text string"), no_items).collect() == []


def test_copies_of_short_and_long_items_equal_brute_force(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(3000)]
    common, own = words[:60], [f"q{k}" for k in range(600)]
    items = {k: rnd.sample(own, n) if k % 2 else [*rnd.sample(own, 1), *rnd.choices(common, k=n - 1)] for k, n in enumerate([*range(1, 16)] * 4)}
    # longer ones that lie among other terms of the benchmark, or repeat a word
    items |= {100 + k: rnd.choices(common, k=20 + k) for k in range(6)} | {200: ["rara"] * 18}
    docs = {}
    for k, item in items.items():
        for d_ in range(3):  # alone, in plain text, among words of other items
            around = rnd.choices((words[60:], words[60:], own + common)[d_], k=(0, 120, 90)[d_])
            at = rnd.randrange(len(around) + 1)
            copy = [x for w in item for x in ((w.upper() + ",", "--") if d_ else (w,))]
            docs[k * 10 + d_] = around[:at] + copy + around[at:]
    docs |= {5000 + k: rnd.choices(words, k=rnd.randrange(1, 200)) for k in range(100)}
    table = spark.createDataFrame([(k, " ".join(t)) for k, t in docs.items()], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in d.leaks(table, bench).collect()}
    plain = {k: f" {' '.join(filter(None, map(d.word, t)))} " for k, t in docs.items()}
    want = {(k, i) for k, t in plain.items() for i, item in items.items() if f" {' '.join(item)} " in t}
    assert want <= set(found) and len(want) >= 3 * len(items)
    assert all(found[x]["lcs"] == 1 and found[x]["answered"] for x in want)


def test_short_items_with_altered_words_equal_brute_force(spark):
    rnd = random.Random(10)
    words = [f"w{k}" for k in range(40)]
    items = [(k, rnd.sample(words, n) if k % 2 else rnd.choices(words, k=n)) for k, n in enumerate([*range(1, 16)] * 2)]
    docs = [(k, rnd.choices(words, k=rnd.randrange(0, 60))) for k in range(60)]
    for k, (_, item) in enumerate(items):
        copy = list(item)
        for _ in range(len(item) // 5):
            copy[rnd.randrange(len(copy))] = rnd.choice(["zz", "--"])
        docs.append((100 + k, rnd.choices(words, k=rnd.randrange(40)) + copy + rnd.choices(words, k=30)))
    want = set()
    for k, t in docs:
        t = [w for w in map(d.word, t) if w]
        for i, item in items:
            span = len(item) + len(item) // 6
            for a in range(len(t)):
                both = brute_common(item, t[a : a + span]) / len(item)
                end = item[-d.END_WORDS :]
                answered = brute_common(end, t[a : a + span]) >= d.END_SHARE * len(end)
                if both >= d.SURE or (len(item) > d.END_WORDS and both >= d.LIKELY and answered):
                    want.add((k, i))
    spark_docs = spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id long, text string")
    found = d.leaks(spark_docs, spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string"))
    assert want <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_no_pass_has_more_items_than_the_basis_has_directions(spark, planted, monkeypatch):
    docs, items, want = planted
    taken, one_pass = [], d._one_pass
    monkeypatch.setattr(d, "RANK", 28)
    monkeypatch.setattr(d, "SURPLUS", 8)
    monkeypatch.setattr(d, "_one_pass", lambda s, t, part, *rest: taken.append(len(part)) or one_pass(s, t, part, *rest))
    found = d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    assert sum(taken) == len(items) and max(taken) <= 20


def test_passes_are_bounded_by_words(spark, planted, monkeypatch):
    docs, items, want = planted
    taken, one_pass = [], d._one_pass
    monkeypatch.setattr(d, "WORDS_A_PASS", 400)
    monkeypatch.setattr(d, "_one_pass", lambda s, t, part, *rest: taken.append(sum(len(x.split()) for _, x in part)) or one_pass(s, t, part, *rest))
    found = d.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    assert sum(taken) == sum(len(x.split()) for _, x in items) and len(taken) > 1 and max(taken) <= 400
    assert d.pass_starts(np.array([30, 10, 20]), np.array([1, 500, 1])) == [20]
