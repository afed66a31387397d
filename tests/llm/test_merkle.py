"""Merkle manifest: every column against a plain recursive version; NULLs, repeats, clashing columns, hot sources."""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text) -> str:
    return h(*map(field, (row[0], row[1], row[2], row[3], text)))


def climb(level: list[str], at: int) -> tuple[str, list[tuple[list[str], list[str]]]]:
    """The root over `level`, and the siblings (before, after) of node `at` on the way."""
    way = []
    while len(level) > 1:
        start = at // 3 * 3
        way.append((level[start:at], level[at + 1 : start + 3]))
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at //= 3
    return level[0], way


def plain(rows) -> list[tuple]:
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(((r, leaf(r, r[4])) for r in rows if r[1] == s), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in sources}
    subroots = [climb([x for _, x in trees[s]], 0)[0] for s in sources]
    out = []
    for n, s in enumerate(sources):
        for i, (r, own) in enumerate(trees[s]):
            _, low = climb([x for _, x in trees[s]], i)
            root, high = climb(subroots, n)
            hit = r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0
            folded = leaf(r, r[4].replace("\n", "") if hit and r[4] is not None else r[4])
            for before, after in low + high:
                folded = h(*before, folded, *after)
            out.append((r[0], own, subroots[n], root, h(*[x for b, a in low + high for x in b + a]), folded, folded == root))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=repr)


def sample() -> list[tuple]:
    rows = [(i, "hot", "en", i, f"line {i}\nnext\n") for i in range(300)]
    rows += [(1000 + i, f"s{i}", None, None, "x\ny" if i % 2 else None) for i in range(100)]
    rows += [(7, None, "é", 3, ""), (None, "hot", None, None, "a\nb"), (7, "hot", "en", 7, "line 7\nnext\n"), (7, "hot", "en", 7, "other"), (-5, "é", "", 0, "\n" * 5)]
    return rows


def test_equals_a_plain_tree(spark):
    rows = sample()
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


@pytest.mark.parametrize("count", [1, 4, 82, 244])
def test_heights_of_one_source(spark, count):
    rows = [(i, "a", "en", 1, f"{i}\n") for i in range(count)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_nodes_under_many_leaves_are_salted(spark, monkeypatch):
    monkeypatch.setattr(merkle, "KEY_LEAVES", 9)
    rows = sample()
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "a", "en", 1, "x\n")] * 5 + [(2, None, None, None, None)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "idx", "digest", "row", "total", "cover", "at", "part", "before", "leaf", "_group", "id", "path", "number"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(df) == plain(rows)


def test_empty_table(spark):
    out = merkle.audit(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_long_text(spark):
    rows = [(5, "a", "en", 1, "word\n" * 200_000), (6, "a", "en", 1, "b")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_climb_is_a_recursive_query(spark):
    df = merkle.audit(spark.createDataFrame(sample(), SCHEMA))
    assert "UnionLoop" in df._jdf.queryExecution().optimizedPlan().toString()
