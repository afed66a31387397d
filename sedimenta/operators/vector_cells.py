"""A vector table in cells around centres: a search leaves out cells that cannot hold one of the k best.

The angle between a query and a member of a cell is at least the angle to the centre less the cell's radius. A first
pass scores the cells around each query until k permitted vectors are in them; the k-th best score found is a floor, and the
second pass scores only cells whose bound reaches it. The result is exact. Tags are folders, so rows that a user may not see
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sedimenta.operators.lookup import local_rows
from sedimenta.operators.vectors import _scorer, _unit, validate_vectors
from sedimenta.session import scratch_path

CELL, ANGLE, GROUP = "celda", "angulo", "grupo"
#: Vectors that the centres are learned from: a bound on the driver's work. Every vector is placed and searched.
SAMPLE = 20_000
MOST_CELLS = 1024
#: Angles are exact to about 1e-8; a cell within this of the floor is scored.
SLACK = 1e-6


class Found(NamedTuple):
    """`rows(query_id, vec_id, score, rn)`, and `scored(query_id, vectores)`: with how many vectors each query was compared."""

    rows: DataFrame
    scored: DataFrame


def centres_of(sample: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centres by k-means on the sphere; begins with points spread over the sample, so the same sample gives the same centres."""
    if not len(sample):
        return np.zeros((0, 0))
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1)
        centres = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-300)[:, None], centres)
    return centres


class VectorCells:
    """Vectors of one size under `base`, in folders by tag and cell. Others, zero and NULL vectors have no cosine and are not stored."""

    def __init__(self, spark: SparkSession, base: str, tags: Sequence[str] = (), vector_id: str = "vec_id", vector: str = "embedding"):
        self.spark, self.base, self.tags, self.id, self.vector = spark, base.rstrip("/"), list(tags), vector_id, vector

    def build(self, vectors: DataFrame, size: int, cells: int | None = None, sample: int = SAMPLE) -> VectorCells:
        """Stores the vectors. `cells` is the number of centres, by default a quarter of the root of the number of vectors, up to `MOST_CELLS`."""
        good = validate_vectors(vectors, size, self.vector).filter("valido").select(self.id, self.vector, *self.tags)
        hashed = F.xxhash64(F.col(self.id))
        count = good.count()
        cells = cells or min(MOST_CELLS, max(1, math.isqrt(count) // 4))
        share = min(1.0, (2 * sample + 100) / max(count, 1))
        some = good.filter(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30)))
        rows = some.select(self.vector, hashed.alias("h")).orderBy("h", self.vector).limit(sample).select(self.vector).toArrow()
        learned = dict(_unit(rows.column(0).combine_chunks())) if rows.num_rows else {}
        centres = centres_of(learned[size][1], cells) if size in learned else np.zeros((0, size))

        schema = T.StructType([*good.schema, T.StructField(CELL, T.IntegerType()), T.StructField(ANGLE, T.DoubleType())])
        arrow = to_arrow_schema(schema)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, (numbers, matrix) in _unit(batch.column(1)):
                    near = matrix @ centres.T
                    best = near.argmax(axis=1)
                    angle = np.arccos(np.clip(near[np.arange(len(best)), best], -1, 1))
                    columns = [*batch.take(pa.array(numbers)).columns, pa.array(best, pa.int32()), pa.array(angle)]
                    yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        folders = [*self.tags, CELL]
        good.mapInArrow(place, schema).hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).parquet(self.base)
        stored = T.StructType([f for f in schema if f.name not in folders] + [schema[f] for f in folders])
        local_rows(self.spark, [], stored).write.mode("overwrite").parquet(f"{self.base}.esquema")
        groups = self._table().groupBy(*folders).agg(F.count(F.lit(1)).alias("n"), F.max(ANGLE).alias("radio"))
        groups.coalesce(1).write.mode("overwrite").parquet(f"{self.base}.celdas")
        listed = [(i, c.tolist()) for i, c in enumerate(centres)]
        local_rows(self.spark, listed, f"{CELL} int, centro array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.base}.centros")
        return self

    def _table(self) -> DataFrame:
        return self.spark.read.schema(self.spark.read.parquet(f"{self.base}.esquema").schema).parquet(self.base)

    def groups(self) -> DataFrame:
        """`(tags, celda, n, radio)`: one row per folder."""
        return self.spark.read.parquet(f"{self.base}.celdas")

    def search(
        self,
        queries: DataFrame,
        k: int,
        allowed: Callable[[DataFrame], DataFrame] | None = None,
        query_id: str = "query_id",
        min_score: float | None = None,
        digits: int = 6,
    ) -> Found:
        """What `vectors.top_k` gives over the permitted rows. `allowed` keeps folders by their tags, as a governance filter of `groups()`.

        Any number of queries: they are split between tasks and written by folder; the driver sees folders only, whose number is
        that of tag values times cells.
        """
        groups = self.groups()
        folders = sorted((allowed(groups) if allowed else groups).collect(), key=lambda r: (r[CELL], *[str(r[t]) for t in self.tags]))
        centres = np.array([r["centro"] for r in self.spark.read.parquet(f"{self.base}.centros").orderBy(CELL).collect()])
        asked = scratch_path(self.spark, "queries")
        queries.select(query_id, F.col(self.vector).cast("array<double>").alias("v")).dropDuplicates([query_id]).write.parquet(asked)
        asked = self.spark.read.parquet(asked)
        none = asked.select(query_id, "v", F.lit(None).cast("double").alias("suelo"))
        first, paths = self._pass(none, folders, centres, k, query_id, min_score, True)
        floor = first.filter(f"rn = {k}").select(query_id, F.col("score").alias("suelo"))
        second, more = self._pass(asked.join(floor, query_id, "left").select(query_id, "v", "suelo"), folders, centres, k, query_id, min_score, False)
        rows = _ranked(first.drop("rn").unionByName(second.drop("rn")), query_id, self.id, k)
        parts = [self.spark.read.parquet(p).select(query_id, GROUP) for p in (*paths, *more)]
        pairs = reduce(DataFrame.unionByName, parts) if parts else None
        sizes = local_rows(self.spark, [(i, r["n"]) for i, r in enumerate(folders)], f"{GROUP} int, n long")
        scored = (
            asked.select(query_id, F.lit(0).cast("long").alias("vectores"))
            if pairs is None
            else asked.select(query_id)
            .join(pairs.join(sizes, GROUP).groupBy(query_id).agg(F.sum("n").alias("vectores")), query_id, "left")
            .select(query_id, F.coalesce("vectores", F.lit(0)).alias("vectores"))
        )
        return Found(rows.withColumn("score", F.round("score", digits)), scored)

    def _pass(self, asked, folders, centres, k, query_id, min_score, first: bool) -> tuple[DataFrame, list[str]]:
        """The best of the folders that this pass scores for each query, stored, and where its (query, folder) pairs are."""
        spark = self.spark
        cell = np.array([r[CELL] for r in folders], int)
        sizes, radius = np.array([r["n"] for r in folders], np.int64), np.array([r["radio"] for r in folders], float)
        kind = T.StructType([asked.schema[query_id], T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField(GROUP, T.IntegerType())])
        arrow = to_arrow_schema(kind)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                floors = batch.column(2).to_pylist()
                for size, (numbers, matrix) in _unit(batch.column(1)):
                    if not len(centres) or size != centres.shape[1]:
                        continue
                    angle = np.arccos(np.clip(matrix @ centres.T, -1, 1))[:, cell]
                    bound = np.cos(np.maximum(angle - radius, 0))
                    rows, wanted = [], []
                    for number, near, reach in zip(numbers.tolist(), angle, bound):
                        possible = reach >= (-2 if min_score is None else min_score) - SLACK
                        order = np.argsort(near, kind="stable")
                        order = order[possible[order]]
                        before = np.cumsum(sizes[order]) - sizes[order]
                        probe = order[before < k]
                        if not first:
                            rest = order[before >= k]
                            floor = floors[number]
                            probe = rest if floor is None else rest[reach[rest] >= floor - SLACK]
                        rows += [number] * len(probe)
                        wanted.append(probe)
                    if rows:
                        some = batch.take(pa.array(rows))
                        columns = [some.column(0), some.column(1), pa.array(np.concatenate(wanted), pa.int32())]
                        yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        path = scratch_path(spark, "cells")
        asked.mapInArrow(choose, kind).write.partitionBy(GROUP).parquet(path)
        pairs = spark.read.schema(kind).parquet(path)
        used = sorted(r[GROUP] for r in pairs.select(GROUP).distinct().collect())
        out = T.StructType([asked.schema[query_id], self._table().schema[self.id], T.StructField("score", T.DoubleType())])
        if not used:
            return local_rows(spark, [], out).withColumn("rn", F.lit(0)), []
        table = self.permitted([folders[g] for g in used])
        number = reduce(lambda c, g: c.when(self._here(folders[g]), g), used[1:], F.when(self._here(folders[used[0]]), used[0]))
        schema = to_arrow_schema(out)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mine = np.asarray(batch.column(2))
                for g in np.unique(mine).tolist():
                    some = batch.select([0, 1]).filter(pa.array(mine == g))
                    yield from _scorer(f"{path}/{GROUP}={g}", k, min_score, schema)(iter([some]))

        best = table.select(self.id, self.vector, number.alias(GROUP)).mapInArrow(score, out)
        kept = scratch_path(spark, "best")
        _ranked(best, query_id, self.id, k).write.parquet(kept)
        return spark.read.parquet(kept), [path]

    def _here(self, folder) -> Column:
        return reduce(Column.__and__, [F.col(t).eqNullSafe(F.lit(folder[t])) for t in self.tags], F.col(CELL) == folder[CELL])

    def permitted(self, folders: Sequence) -> DataFrame:
        """The rows of the given folders; a condition on partition columns only, so others are not listed into the scan."""
        by_tags: dict[tuple, list[int]] = {}
        for r in folders:
            by_tags.setdefault(tuple(r[t] for t in self.tags), []).append(r[CELL])
        tests = [
            reduce(Column.__and__, [F.col(t).eqNullSafe(F.lit(v)) for t, v in zip(self.tags, values)], F.col(CELL).isin(cells))
            for values, cells in by_tags.items()
        ]
        return self._table().filter(reduce(Column.__or__, tests, F.lit(False)))


def _ranked(df: DataFrame, query_id: str, vector_id: str, k: int) -> DataFrame:
    window = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(vector_id))
    return df.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") <= k)
