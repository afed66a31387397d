"""Language, toxicity and quality: gradients, formulas, held-out accuracy on the synthetic tables, and edge rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import langid, quality, queries, toxicity
from sedimenta.llm.common import table

FOLDER = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, "12 34 !!"), (None, "the of and"), (4, "word " * 40_000), (5, "same"), (5, "same"), (6, "é"), (7, "x" * 100_000)]


def edges(spark):
    return spark.createDataFrame([(*r, "zz", 3.0, 7) for r in EDGES], "doc_id long, text string, lang_pred string, score double, predicted int")


# -- language -------------------------------------------------------------------------------


def test_gradients_by_backpropagation_through_time_equal_differences():
    rnd = np.random.default_rng(0)
    net = langid.BiGRU.fresh(3, hidden=4, seed=1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    codes, label = rnd.integers(0, 256, (6, 5)), rnd.integers(0, 3, 5)
    mask = (np.arange(6)[:, None] < rnd.integers(1, 7, 5)).astype(np.float64)
    _, g = net.gradients(codes, mask, label)
    for name, w in net.w.items():
        for _ in range(4):
            at = tuple(rnd.integers(0, n) for n in w.shape)
            if name[0] == "W" and name != "Wo":
                at = (int(codes[0, 0]), at[1])
            keep, eps = w[at], 1e-3
            w[at] = keep + eps
            up = net.gradients(codes, mask, label)[0]
            w[at] = keep - eps
            down = net.gradients(codes, mask, label)[0]
            w[at] = keep
            assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-4, (name, at)


def test_pooled_probabilities_equal_the_written_out_formula():
    """A plain loop over bytes and units, one text at a time: the state restarts at every window."""
    rnd = np.random.default_rng(4)
    net = langid.BiGRU.fresh(3, hidden=4, seed=2)
    net.w = {k: (v + 0.1 * rnd.standard_normal(v.shape)).astype(np.float32) for k, v in net.w.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    texts = [bytes(rnd.integers(0, 256, n).astype(np.uint8)) for n in (1, 64, 100, 130)]
    got = langid.Detector(["a", "b", "c"], net).pooled(texts)
    for text, mean in zip(texts, got):
        total = np.zeros(3)
        for start in range(0, len(text), langid.WINDOW):
            part = text[start : start + langid.WINDOW]
            states = {}
            for d, order in (("f", range(len(part))), ("b", range(len(part) - 1, -1, -1))):
                W, U, c, h = (*(net.w[x + d].astype(float) for x in "WUc"), np.zeros(4))
                for t in order:
                    x, u = W[part[t]], U @ h
                    z, r = sig(x[:4] + u[:4]), sig(x[4:8] + u[4:8])
                    n = np.tanh(x[8:] + r * (u[8:] + c))
                    h = (1 - z) * n + z * h
                    states[d, t] = h
            for t in range(len(part)):
                e = np.exp(net.w["Wo"] @ np.concatenate([states["f", t], states["b", t]]) + net.w["bo"])
                total += e / e.sum()
        assert np.allclose(mean, total / len(text), atol=1e-5)


def test_training_reads_whole_texts_of_few_rows(spark):
    rows = [(i, f"{'ab'[i % 2]} " * (1 + i * 50), "xy"[i % 2]) for i in range(40)] + [(None, "zz", "x"), (90, None, "x"), (91, "12", "y"), (92, "text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {(lang, text) for _, text, lang in rows}
    some = [tuple(r) for r in langid.training_rows(docs, 5).collect()]
    assert len(some) == 10 and set(some) <= whole and {lang for lang, _ in some} == {"x", "y"}


def test_windows_cover_whole_texts_and_pooling_is_the_mean():
    rnd = np.random.default_rng(1)
    texts = [bytes(rnd.integers(1, 256, n).astype(np.uint8)) for n in (0, 1, 63, 64, 65, 200, 1000)]
    codes, lengths, owner = langid.windows(texts)
    assert [sum(lengths[owner == i]) for i in range(len(texts))] == [*map(len, texts)]
    own = langid.Detector(["a", "b"], langid.BiGRU.fresh(2))
    pooled = own.pooled(texts)
    for p, each, t in zip(pooled, own.positions(texts), texts):
        assert each.shape == (len(t), 2)
        assert np.allclose(p, each.mean(axis=0) if len(t) else 0, atol=1e-5)


def test_language_held_out(spark):
    out = queries.QUERIES["op9_language"](spark, FOLDER).join(table(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id")
    row = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert row["right"] > 0.97 and 0 <= row["low"] and row["high"] <= 1
    assert out.count() == 1000


def test_language_of_edge_rows(spark):
    docs = table(spark, FOLDER, "documents").filter("doc_id < 300")
    model = langid.ship(spark, langid.train(docs, rows=60, epochs=3))
    out = langid.identify(edges(spark), model).collect()
    assert [r["doc_id"] for r in out] == [i for i, _ in EDGES]
    assert [r["lang_pred"] == "und" and r["score"] == 0 for r in out] == [t is None or not any(c.isalpha() for c in t) for _, t in EDGES]
    spans = {r["doc_id"]: r["spans"] for r in langid.language_spans(edges(spark), model).collect()}
    assert sum(s["length"] for s in spans[4]) == 200_000 and spans[1] == []
    kept = langid.keep_identified(edges(spark), model, 0.0)
    assert kept.columns == edges(spark).columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 5, 6, 7]


def test_signs_that_are_no_letters(spark):
    model = langid.ship(spark, langid.train(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")))
    rows = [(1, "½ ² Ⅷ ① 12 _"), (2, "ª"), (3, "中"), (4, "é")]
    assert not langid._LETTER.search(rows[0][1]) and all(langid._LETTER.search(t) for _, t in rows[1:])
    assert [r["lang_pred"] for r in langid.identify(spark.createDataFrame(rows[:1], "doc_id long, text string"), model).collect()] == ["und"]


def test_language_without_labels(spark):
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.ship(spark, langid.train(none))
    assert [tuple(r) for r in langid.identify(none, model).collect()] == [(1, "und", 0.0)]
    assert langid.identify(none.filter("false"), model).collect() == []


# -- toxicity -------------------------------------------------------------------------------


def test_risk_derivatives_and_clamp():
    rnd = np.random.default_rng(2)
    for shift in (0.0, 6.0):  # with confident scores of the toxic the difference turns negative
        p, u = rnd.standard_normal(7) + shift, rnd.standard_normal(9) - shift
        base, g_p, g_u = toxicity.risk_step(p, u, 0.4)
        soft = np.logaddexp(0, u).mean() - 0.4 * np.logaddexp(0, p).mean()
        assert (soft < 0) == (shift > 0)
        if shift == 0:
            for k in range(7):
                q = p.copy()
                q[k] += 1e-6
                assert abs((toxicity.risk_step(q, u, 0.4)[0] - base) / 1e-6 - g_p[k]) < 1e-4
        else:
            assert base == pytest.approx(0.4 * np.logaddexp(0, -p).mean()) and (g_u <= 0).all()


def test_scores_equal_a_plain_loop_over_features():
    """Features are found again from their definition, without the cache, and summed one by one."""
    rnd = np.random.default_rng(5)
    texts = ["Bad badly BAD badness good", "", "fine words, bad-tempered words", "x " * 50 + "badger badminton", "Ünïcode ünïversal bad 12"]
    every = sorted({x for t in texts for x in toxicity._Features().of(t)})
    own = toxicity.Classifier(every[::2], rnd.standard_normal((3, len(every[::2]))), rnd.standard_normal(3))
    for text, score in zip(texts, own.scores(texts)):
        per_chunk = [set(toxicity.chunk_features(c)) for c in set(text.split())]
        present = {x for xs in per_chunk for x in xs}
        present |= {x + toxicity.BUCKETS for x in present if sum(x in xs for xs in per_chunk) > 1}
        votes = []
        for member in range(3):
            f = own.bias[member]
            for at, x in enumerate(own.features):
                if x in present:
                    f += own.weights[member, at]
            votes.append(1 / (1 + np.exp(-f)))
        assert score == pytest.approx(sum(votes) / 3, abs=1e-12)


def test_every_feature_that_passes_is_used():
    wide = toxicity.Presence(np.full(40, 6000), np.tile(np.arange(6000, dtype=np.int32), 40))
    plain = toxicity.Presence(np.full(400, 1), np.full(400, 7000, np.int32))
    assert len(toxicity.fit(wide, plain, 0.5, steps=2).features) == 6000


def test_presence_counts_and_cells_in_little_memory():
    import tracemalloc

    rnd = np.random.default_rng(3)
    sizes = rnd.integers(0, 3000, 3000).astype(np.int32)
    features = rnd.integers(0, 2 * toxicity.BUCKETS, sizes.sum()).astype(np.int32)
    place = np.full(2 * toxicity.BUCKETS, -1, np.int32)
    chosen = rnd.choice(2 * toxicity.BUCKETS, 2000, replace=False)
    place[chosen] = np.arange(2000)
    own = toxicity.Presence(sizes, features)
    tracemalloc.start()
    counts, (rows, columns) = own.counts(), own.cells(place)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    some = place[features] >= 0
    assert counts.tolist() == np.bincount(features, minlength=2 * toxicity.BUCKETS).tolist()
    assert rows.tolist() == np.repeat(np.arange(len(sizes)), sizes)[some].tolist()
    assert columns.tolist() == place[features][some].tolist()
    # two arrays of counts and some pieces, whatever the sample's size; before, also eight bytes for each of its features
    assert peak < 2 * counts.nbytes + 8 * 8 * toxicity.PIECE, peak
    none = toxicity.Presence(np.zeros(0, np.int32), np.zeros(0, np.int32))
    assert not none.counts().any() and [len(x) for x in none.cells(place)] == [0, 0]


def test_memory_goes_back_after_each_block_of_texts(monkeypatch):
    import pyarrow as pa

    from sedimenta.llm import common

    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(len(got)))
    got: list = []
    for block in common.blocks(pa.record_batch([pa.array(["x" * 60] * 10)], names=["text"]), "text", 100):
        got.append(block.num_rows)
    assert sum(got) == 10 and len(got) > 3
    assert calls == list(range(1, len(got) + 1))


def test_toxicity_held_out(spark):
    out = queries.QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("held_out")
    row = out.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong")).first()
    assert row["caught"] > 0.85 and row["wrong"] < 0.03


def test_toxicity_of_edge_rows(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = toxicity.ship(spark, toxicity.train(docs, labels))
    out = toxicity.score(edges(spark), model).collect()
    assert [r["doc_id"] for r in out] == [i for i, _ in EDGES] and all(0 <= r["score"] <= 1 for r in out)
    assert out[0]["score"] == out[1]["score"] and out[5] == out[6]
    kept = toxicity.keep_harmless(edges(spark), model)
    assert kept.columns == edges(spark).columns and kept.count() == len(EDGES)
    none = toxicity.ship(spark, toxicity.train(docs, labels.filter("false")))
    assert {r["predicted"] for r in toxicity.score(docs.limit(5), none).collect()} == {0}
    assert toxicity.score(docs.filter("false"), model).collect() == []


# -- quality --------------------------------------------------------------------------------


def test_machine_equals_the_sum_over_all_pairs():
    rnd = np.random.default_rng(3)
    machine = quality.Machine(0.3, np.zeros((quality.BUCKETS, quality.FACTORS + 1), np.float32), rnd.standard_normal((len(quality.STATISTICS), quality.FACTORS + 1)), rnd.standard_normal(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    machine.word[:50] = rnd.standard_normal((50, quality.FACTORS + 1))
    machine.squares = machine.word[:, 1:] ** 2
    words, stats = [np.array([3, 3, 49], np.int32), np.zeros(0, np.int32)], rnd.standard_normal((2, len(quality.STATISTICS)))
    got = machine.scores(words, stats)
    for w, s, score in zip(words, stats, got):
        rows = [(1 / len(w), machine.word[i].astype(float)) for i in w] + [*zip(machine.scaled(s), machine.stat)]
        y = machine.bias + sum(x * v[0] for x, v in rows)
        y += sum(rows[i][0] * rows[j][0] * (rows[i][1][1:] @ rows[j][1][1:]) for i in range(len(rows)) for j in range(i))
        assert score == pytest.approx(1 / (1 + np.exp(-y)), abs=1e-6)


def test_quality_held_out(spark):
    out = queries.QUERIES["op10_quality"](spark, FOLDER).join(table(spark, FOLDER, "labels"), "doc_id").filter("held_out")
    assert out.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


def test_quality_of_edge_rows(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = quality.ship(spark, quality.train(docs, labels))
    out = quality.score(edges(spark), model).collect()
    assert [r["doc_id"] for r in out] == [i for i, _ in EDGES] and all(0 <= r["score"] <= 1 for r in out)
    assert out[0]["score"] == out[1]["score"] and out[5] == out[6]
    for some in (labels.filter("false"), labels.filter("quality = 1")):
        one = quality.ship(spark, quality.train(docs, some))
        assert len({r["score"] for r in quality.score(docs.limit(5), one).collect()}) == 1
    assert quality.score(docs.filter("false"), model).collect() == []
