"""Ranked lexical search against a plain scorer; blocks that are never unpacked; ties, NULLs, clashing columns."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sedimenta.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text) -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k=20) -> list[tuple]:
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n, total = len(found), sum(x for *_, x in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    asked: dict = {}
    for i, text in dict.fromkeys((i, t) for i, t in items if i is not None):
        asked.setdefault(i, Counter()).update(terms(text))
    for item, own in asked.items():
        scores = []
        for doc, c, length in found:
            m = 75 + 25 * length * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, r in own.items() if t in c)
            if s > 0 and doc is not None:
                scores.append((-s, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(many: int, seed: int = 3) -> tuple[list, list]:
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([3, 20, 90])))) for i in range(many)]
    items = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 4, 15])))) for i in range(25)]
    return docs, items


def got(spark, docs, items, **options) -> list[tuple]:
    return sorted(tuple(r) for r in lexical.rank(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options).collect())


def test_equals_a_plain_scorer(spark):
    docs, items = corpus(900)
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, k=3, shard_docs=50) == plain(docs, items, 3)


def test_edge_rows(spark):
    docs = [(1, "Straße ÀB-cd_ef 1a"), (2, "straße"), (2, "straße"), (3, None), (4, ""), (5, "!!! --"), (None, "straße straße"), (6, "x" * 200_000 + " straße"), (7, "\x00a\x7fb")]
    items = [(1, "STRAßE straße"), (2, None), (3, ""), (4, "absent"), (None, "straße"), (5, "a b cd CD àb"), (1, "STRAßE straße"), (6, "x" * 200_000)]
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, shard_docs=1) == plain(docs, items)


def test_ties_go_by_id_across_shards(spark):
    docs = [(i, "same words here") for i in range(60)] + [(100, "other")] * 3
    assert [r[2] for r in got(spark, docs, [(1, "same")], shard_docs=7)] == [*range(20)]


def test_empty_tables_and_clashing_columns(spark):
    docs, items = corpus(40)
    assert got(spark, [], items) == [] and got(spark, docs, []) == []
    assert got(spark, docs, [(1, "absent"), (2, "words")]) == []
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    for name in ("id", "terms", "df", "shard", "score", "rank", "term", "weight", "words", "word"):
        d, i = d.withColumn(name, F.lit("clash")), i.withColumn(name, F.lit("clash"))
    assert sorted(tuple(r) for r in lexical.rank(d, i).collect()) == plain(docs, items)


def shard_of(docs) -> tuple[lexical.Shard, dict]:
    numbers: dict = {}
    words = [np.array([numbers.setdefault(t, len(numbers)) for t in lexical.terms_of(text.encode())], np.int32) for _, text in docs]
    row = lexical.pack([i for i, _ in docs], words, [*numbers])
    return lexical.Shard(pa.array(row["terms"], pa.binary()), row["shard"], row["documents"], row["words"]), row


def test_blocks_open_to_the_postings_and_maxima_hold():
    docs = [(i, f"all {'rare ' if i % 997 == 0 else ''}" + "all " * (i % 300) + "pad " * (i % 7)) for i in range(5000)]
    shard, row = shard_of(docs)
    for number, term in enumerate(row["terms"]):
        blocks = np.arange(shard.blocks[number], shard.blocks[number + 1])
        doc, value = shard.open(blocks)
        want = [(i, lexical.terms_of(t.encode()).count(term)) for i, t in docs if term in lexical.terms_of(t.encode())]
        assert doc.tolist() == [i for i, _ in want]
        exact = lexical.impact(np.array([c for _, c in want]), shard.length[doc], row["documents"], row["words"])
        assert value.tolist() == exact.tolist()
        ends = np.cumsum(shard.size[blocks].astype(np.int64))
        assert shard.most[blocks].tolist() == [int(exact[a:b].max()) for a, b in zip([0, *ends[:-1]], ends)]


def test_maxima_reject_documents_before_their_blocks_are_unpacked():
    rnd = random.Random(1)
    docs = [(i, "common " * rnd.randint(1, 2) + " ".join(f"f{rnd.randint(0, 400)}" for _ in range(rnd.randint(5, 40))) + (" needle" * 9 if i in (70, 4000) else "")) for i in range(20_000)]
    shard, row = shard_of(docs)
    numbers = shard.numbers(pa.array([b"needle", b"common"], pa.binary()))
    places, scores = shard.top(numbers, np.array([9000, 40]), 2, 1)
    assert shard.ids[places].tolist() == [70, 4000] or sorted(shard.ids[places].tolist()) == [70, 4000]
    assert shard.unpacked <= 4 < shard.blocks[numbers[1] + 1] - shard.blocks[numbers[1]]
    assert len(scores) == 2


def test_impacts_do_not_overflow():
    out = lexical.impact(np.array([1, 2]), np.array([10**12, 5]), 10**9, 10**13)
    assert out.tolist() == [10**9 // (1000 + 12 * (75 + 25 * 10**12 * 10**9 // 10**13)), 2 * 10**9 // (2000 + 12 * (75 + 25 * 5 * 10**9 // 10**13))]


def test_a_task_holds_one_shard_at_a_time(spark, tmp_path, monkeypatch):
    """Row groups end with their shard, and the search moves places of shards, not shards, through the JVM."""
    docs, items = corpus(400)
    frame = spark.createDataFrame(docs, DOCS).repartition(2)
    monkeypatch.setattr(lexical, "GROUP_BYTES", 2000)
    index = lexical.write_index(frame, f"{tmp_path}/index", shard_docs=20)
    files = [pq.ParquetFile(f) for f in (tmp_path / "index").glob("*.parquet")]
    assert [f.metadata.row_group(g).num_rows for f in files for g in range(f.metadata.num_row_groups)] == [1] * index.count()
    assert index.count() >= 20
    # rows of a group that several share are found as well, also by a task that begins inside a file
    monkeypatch.setattr(lexical, "GROUP_BYTES", 1 << 20)
    index = lexical.write_index(frame, f"{tmp_path}/wide", shard_docs=20)
    files = [pq.ParquetFile(f) for f in (tmp_path / "wide").glob("*.parquet")]
    assert any(f.metadata.row_group(g).num_rows > 1 for f in files for g in range(f.metadata.num_row_groups))
    whole = {(f, i): r["shard"] for f in sorted(x.name for x in (tmp_path / "wide").glob("*.parquet")) for i, r in enumerate(pq.read_table(tmp_path / "wide" / f).to_pylist())}
    some = sorted(whole)[3::2]
    wanted = pa.record_batch([pa.array([f for f, _ in some]), pa.array([i for _, i in some])], names=["file", "row"])
    assert [raw for _, raw in lexical._shards(f"{tmp_path}/wide", wanted)] == [whole[x] for x in some]
    ranked = lexical.rank(frame, spark.createDataFrame(items, ITEMS), shard_docs=20)
    assert "shard:binary" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in ranked.collect()) == plain(docs, items)
