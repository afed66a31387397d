"""Vectors in cells: the same rows as the scan of all, fewer vectors scored, only permitted folders read."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import vectors
from sedimenta.operators.vector_cells import VectorCells, centres_of

SCHEMA = "vec_id long, idioma string, embedding array<float>"


def clustered(spark, n=600, clusters=12, size=8, seed=1):
    rnd = np.random.default_rng(seed)
    middle = rnd.standard_normal((clusters, size)) * 4
    rows = [(i, ["en", "es", None][i % 3], (middle[i % clusters] + rnd.standard_normal(size) * 0.2).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, "en", None), (n + 1, "en", [0.0] * size), (n + 2, "es", [1.0] * (size + 1)), (n + 3, None, rows[0][2]), (n + 4, "en", rows[0][2])]
    return spark.createDataFrame(rows, SCHEMA), [(j, (middle[j] * 2).tolist()) for j in range(clusters)]


def rows_of(df):
    return sorted(map(tuple, df.select("query_id", "vec_id", "score", "rn").collect()))


@pytest.mark.parametrize(("k", "floor"), [(1, None), (10, None), (10, 0.999), (100, None), (5000, None)])
def test_equal_to_the_scan(spark, tmp_path, k, floor):
    table, asked = clustered(spark)
    extra = [(98, [0.0] * 8), (99, None), (97, [1.0] * 3), (0, asked[0][1])]
    queries = spark.createDataFrame(asked + extra, "query_id long, embedding array<double>")
    store = VectorCells(spark, str(tmp_path / "v")).build(table, 8, 12)
    found = store.search(queries, k, min_score=floor)
    own = table.filter(F.size("embedding") == 8)
    assert rows_of(found.rows) == rows_of(vectors.top_k(own, queries, k, min_score=floor))
    scored = {r["query_id"]: r["vectores"] for r in found.scored.collect()}
    assert set(scored) == {*range(12), 97, 98, 99} and scored[98] == scored[97] == 0
    if k <= 10:
        assert sum(scored.values()) < 0.4 * 12 * 602


def test_only_permitted_folders_are_read(spark, tmp_path):
    table, asked = clustered(spark)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    store = VectorCells(spark, str(tmp_path / "v"), ["idioma"]).build(table, 8, 12)
    for test in ("idioma = 'es'", "idioma IS NULL", "idioma IN ('en', 'es')", "idioma = 'xx'"):
        found = store.search(queries, 7, lambda df, t=test: df.filter(t))
        assert rows_of(found.rows) == rows_of(vectors.top_k(table.filter(test).filter(F.size("embedding") == 8), queries, 7))
    folders = store.groups().filter("idioma = 'es'").collect()
    some = store.permitted(folders)
    assert some.count() == 200
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "idioma" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_tables_and_repeated_ids(spark, tmp_path):
    table, asked = clustered(spark, 30, 3)
    queries = spark.createDataFrame(asked, "query_id long, embedding array<double>")
    empty = VectorCells(spark, str(tmp_path / "e")).build(table.limit(0), 8)
    assert empty.search(queries, 3).rows.collect() == [] and {r[1] for r in empty.search(queries, 3).scored.collect()} == {0}
    full = VectorCells(spark, str(tmp_path / "f")).build(table.unionByName(table), 8)
    assert full.search(queries.limit(0), 3).rows.collect() == []
    got = full.search(queries, 4).rows.collect()
    assert len(got) == 12 and len({(r["query_id"], r["vec_id"]) for r in got}) == 6


def test_centres_do_not_depend_on_empty_cells():
    same = np.tile([1.0, 0.0], (5, 1))
    assert np.allclose(centres_of(same, 3), [[1, 0]] * 3) and centres_of(np.zeros((0, 2)), 3).shape == (0, 0)
