"""Each stage of the pipeline against a plain version of it, on the smallest tables; columns, edge rows and registration."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest
from test_ngram_join import shingles
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from sedimenta.llm import decontamination, langid, toxicity
from sedimenta.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), name)
        out.append((before, docs))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns_and_shrink(stages):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for before, after in stages[:-1]:
        assert before.columns == after.columns == names
        assert 0 < after.count() <= before.count()
        assert after.join(before, names, "left_anti").count() == 0


def test_language_stage(spark, stages):
    before, after = stages[0]
    model, rows = langid.train(before), texts(before)
    names, scores = model.predict([*rows.values()])
    want = {d for d, n, s in zip(rows, names, scores) if n != "und" and s >= corpus_pipeline.LEAST_LANGUAGE}
    assert set(texts(after)) == want


def test_toxicity_stage(spark, stages):
    before, after = stages[1]
    model, rows = toxicity.train(before, table(spark, FOLDER, "labels")), texts(before)
    assert set(texts(after)) == {d for d, s in zip(rows, model.scores([*rows.values()])) if s < corpus_pipeline.TOXIC}


def test_near_copy_stage(stages):
    before, after = stages[2]
    sets = {d: shingles(t, corpus_pipeline.SHINGLE_WORDS) for d, t in sorted(texts(before).items())}
    group = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert set(texts(after)) == {d for d, g in group.items() if d == g}


def test_decontamination_stage(spark, stages):
    before, after = stages[3]
    items = [[w for w in map(decontamination.word, r["text"].split()) if w] for r in table(spark, FOLDER, "benchmark").collect()]
    gone = set()
    for d, t in texts(before).items():
        words = [*map(decontamination.word, t.split())]
        for item in items:
            starts = range(0, max(1, len(words)), decontamination.STRIDE)
            if any(decontamination.leak(item, words[max(0, s - len(item)) : s + decontamination.WINDOW + len(item)])[0] for s in starts):
                gone.add(d)
    assert gone and set(texts(after)) == set(texts(before)) - gone


def test_token_stage(stages):
    before, after = stages[4]
    own = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after.collect()}
    for d, t in texts(before).items():
        ids = own.encode(t, add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        assert got.pop(d) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest())
    assert not got


def test_edge_rows_pass_through_every_stage(spark):
    docs = table(spark, FOLDER, "documents")
    odd = [(90_001, None, None, None, None), (90_002, "", "en", "s", 0), (None, "the of and that", "en", "s", 15), (90_003, "word " * 30_000, "en", "s", 150_000)]
    df = docs.limit(60).unionByName(spark.createDataFrame(odd, docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, FOLDER), name)
    assert {90_001, 90_002}.isdisjoint(r["doc_id"] for r in df.select("doc_id").collect())
    empty = docs.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, FOLDER), name)
    assert empty.count() == 0


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == [*range(1, 14)] and "pipeline" in entry.queries()
