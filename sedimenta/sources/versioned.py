"""Tables whose partitions are replaced one by one, without touching the files of the others.

A run writes the partitions it replaces into a folder of its own and, last, a manifest: which run holds the current
rows of every partition value. Nothing that another run wrote is changed, so a reader of an older manifest keeps its table, a
run that failed is repeated from the manifest before it, and a value that got no rows is gone from the new one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.lookup import local_rows
from sedimenta.sources.sinks import read_if_exists

#: Name of the folder level that tells runs apart.
RUN = "_corrida"
#: Codec of the files: hex digests, the widest columns of chunks, halve under it and not under the default.
CODEC = "zstd"
#: Makes the stored rows of rows, one by one.
Build = Callable[[DataFrame], DataFrame]


class VersionedTable:
    """Parquet under `base`, split by the text column `key` and perhaps further columns.

    Manifests have one row per value of `key`, which is bounded by the layout: buckets or declared sources, not ids.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, below: tuple[str, ...] = ()):
        self.spark, self.base, self.key, self.below = spark, base.rstrip("/"), key, below

    def _manifest_path(self, run: str) -> str:
        return f"{self.base}.manifiestos/{run}"

    def manifest(self, run: str | None) -> dict[str, str]:
        """Value -> run that holds it; empty where nothing was written."""
        rows = read_if_exists(self.spark, self._manifest_path(run)) if run else None
        return {} if rows is None else {r["valor"]: r["corrida"] for r in rows.filter("valor IS NOT NULL").collect()}

    def _schema(self, run: str) -> T.StructType:
        rows = self.spark.read.parquet(self._manifest_path(run)).filter("valor IS NULL").first()
        return T.StructType.fromJson(json.loads(rows["esquema"]))

    def _held(self, manifest: dict[str, str]) -> Column:
        """The folders a manifest names, as a condition on partition columns only."""
        by_run: dict[str, list[str]] = {}
        for value, run in manifest.items():
            by_run.setdefault(run, []).append(value)
        tests = [(F.col(RUN) == run) & F.col(self.key).isin(values) for run, values in by_run.items()]
        return reduce(Column.__or__, tests, F.lit(False))

    def read(self, run: str | None, values: Iterable[str] | None = None) -> DataFrame | None:
        """The table as of `run`, or only the given values of the key; None where nothing was written. Other folders are not listed into the scan."""
        manifest = self.manifest(run)
        if run is None or read_if_exists(self.spark, self._manifest_path(run)) is None:
            return None
        if values is not None:
            wanted = set(values)
            manifest = {v: r for v, r in manifest.items() if v in wanted}
        schema = self._schema(run)
        partitions = [T.StructField(RUN, T.StringType())]
        full = T.StructType([f for f in schema if f.name != self.key and f.name not in self.below] + partitions + [schema[self.key]] + [schema[c] for c in self.below])
        runs = sorted(set(manifest.values()))
        if not runs:
            return local_rows(self.spark, [], schema)
        # the runs in use are read as one table, so that their folders' names become columns
        paths = [f"{self.base}/{RUN}={r}" for r in runs]
        table = self.spark.read.schema(full).option("basePath", self.base).parquet(*paths)
        return table.filter(self._held(manifest)).select(*[f.name for f in schema])

    def replace(
        self,
        df: DataFrame,
        run: str,
        previous: str | None,
        touched: Iterable[str] | None = None,
        watch: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Replaces the `touched` values by the rows of `df`, which must have no others, and returns the table as of `run`.

        Without `touched` the whole table is replaced. `watch` may observe the rows in the stage that writes them.

        Values with many rows are split between tasks, so that no task writes a large partition alone.
        """
        return self.replace_built([(df, None)], run, previous, touched, watch)

    def replace_built(
        self,
        parts: Sequence[tuple[DataFrame, Build | None]],
        run: str,
        previous: str | None,
        touched: Iterable[str] | None = None,
        watch: Callable[[DataFrame], DataFrame] | None = None,
        placed: bool = False,
    ) -> DataFrame:
        """`replace` by the rows of several parts, each `(rows, build)`: rows are dealt out and sorted as they are, the task that writes builds from them.

        So no shuffle and no sort carries what a row can be built to. A build keeps the key columns as they come and gives one
        schema in all parts; `watch` is asked for every part. Rows that are `placed` come in ranges of the key columns and are
        written as they are dealt.
        """
        path = f"{self.base}/{RUN}={run}"
        columns = [self.key, *self.below]
        schema = None
        for rows, build in parts:
            dealt = rows if placed else rows.hint("rebalance", *columns)
            built = build(dealt.sortWithinPartitions(*columns)) if build else dealt
            mine = T.StructType([T.StructField(f.name, f.dataType) for f in built.schema])
            if schema is not None and mine.simpleString() != schema.simpleString():
                raise ValueError(f"parts of different columns: {schema.simpleString()} and {mine.simpleString()}")
            mode, schema = "overwrite" if schema is None else "append", mine
            (watch(built) if watch else built).write.mode(mode).option("compression", CODEC).partitionBy(*columns).parquet(path)
        stored = T.StructType([f for f in schema if f.name not in columns] + [schema[c] for c in columns])
        found = self.spark.read.schema(stored).parquet(path).select(self.key).distinct().collect()
        written = {r[self.key] for r in found}
        kept = {} if touched is None else self.manifest(previous)
        touched = written if touched is None else set(touched)
        if not written <= touched:
            raise ValueError(f"rows of other values than those touched: {sorted(written - touched)[:5]}")
        manifest = {v: r for v, r in kept.items() if v not in touched} | dict.fromkeys(written, run)
        return self._publish(run, manifest, schema.json())

    def keep(self, run: str, previous: str, gone: Iterable[str] = ()) -> DataFrame:
        """The table of `previous` as of `run`, without the values that are gone; no data is read or written."""
        gone = set(gone)
        return self._publish(run, {v: r for v, r in self.manifest(previous).items() if v not in gone}, self._schema(previous).json())

    def _publish(self, run: str, manifest: dict[str, str], schema: str) -> DataFrame:
        rows = [(v, r, None) for v, r in sorted(manifest.items())] + [(None, None, schema)]
        local_rows(self.spark, rows, "valor string, corrida string, esquema string").coalesce(1).write.mode("overwrite").parquet(self._manifest_path(run))
        return self.read(run)
