"""Snapshots whose closed versions are never read again and whose open ones lie in buckets by key.

A load compares a digest of each bucket of its source with that of the load before it. Only buckets that differ are read and
written; versions it closes go into a partition of their own. Rows are those of `operators.history.scd2_snapshot`.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators import history
from sedimenta.operators.lookup import local_rows
from sedimenta.sources.sinks import read_if_exists
from sedimenta.sources.versioned import VersionedTable

PART, CLOSED = "parte", "cerradas-"


class SnapshotStore:
    """Versions under `base`, open ones in `buckets` partitions by a hash of the key; one more partition for each load that closed some."""

    def __init__(self, spark: SparkSession, base: str, key: Sequence[str], check_cols: Sequence[str], buckets: int = 64):
        self.spark, self.key, self.check, self.buckets = spark, list(key), list(check_cols), buckets
        self.compared = list(dict.fromkeys([*key, *check_cols]))
        self.table = VersionedTable(spark, base, PART)
        self.digests = f"{base.rstrip('/')}.huellas"

    def _hashed(self, df: DataFrame, columns: Sequence[str], seed: int) -> Column:
        """Equal for values that compare equal, NULLs and both zeros included."""
        kinds = dict(df.dtypes)
        plain = [F.col(c) + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(c) for c in columns]
        return F.xxhash64(F.lit(seed), *[x for c, p in zip(columns, plain) for x in (F.col(c).isNull(), p)])

    def _placed(self, df: DataFrame) -> DataFrame:
        bucket = F.format_string("%05d", F.pmod(self._hashed(df, self.key, 0), F.lit(self.buckets)))
        return df.withColumn(PART, bucket)

    def source_digests(self, source: DataFrame) -> dict[str, str]:
        """Bucket -> row count and two sums of row hashes of what is compared, whatever the order; one entry per bucket."""
        placed = self._placed(source)
        sums = [F.sum(self._hashed(source, self.compared, seed).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
        kinds = dict(source.dtypes)
        names = F.md5(F.lit("\x1f".join(f"{c} {kinds[c]}" for c in self.compared) + f"\x1f{self.buckets}"))
        rows = placed.groupBy(PART).agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums, names).alias("huella")).collect()
        return {r[PART]: r["huella"] for r in rows}

    def _digests_of(self, run: str | None) -> dict[str, str]:
        rows = read_if_exists(self.spark, f"{self.digests}/{run}") if run else None
        return {} if rows is None else {r[PART]: r["huella"] for r in rows.collect()}

    def load(self, source: DataFrame, run: str, previous: str | None, now: datetime | Column) -> list[str]:
        """Adds a load to the versions as of `previous` and returns the buckets it read and wrote.

        Without `previous` every row is a first version. A run may be repeated. `source` is read twice and should be stored. A bucket with
        the digest it had in the load before brings nothing: its rows are open already.
        """
        found = self.source_digests(source)
        before = self._digests_of(previous)
        touched = sorted(b for b, d in found.items() if before.get(b) != d)
        known = self.table.read(previous, touched)
        part = self._placed(source).filter(F.col(PART).isin(touched)).drop(PART)
        if known is None:
            self.table.replace(self._placed(history.scd2_first(part, self.key, now)), run, None)
        else:
            versions = history.scd2_snapshot(known.drop(PART), part, self.key, self.check, now)
            own = f"{CLOSED}{run}"
            placed = self._placed(versions)
            placed = placed.withColumn(PART, F.when(F.col(history.VALID_TO).isNull(), F.col(PART)).otherwise(F.lit(own)))
            self.table.replace(placed, run, previous, [*touched, own])
        # last: a run without digests is compared with nothing, so a later one looks at every bucket
        rows = local_rows(self.spark, sorted(found.items()), f"{PART} string, huella string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.digests}/{run}")
        return touched

    def versions(self, run: str) -> DataFrame:
        """Every version as of `run`, open and closed."""
        return self.table.read(run).drop(PART)

    def current(self, run: str) -> DataFrame:
        """Open versions without the technical columns; partitions of closed ones are not read."""
        opened = [p for p in self.table.manifest(run) if not p.startswith(CLOSED)]
        return history.scd2_current(self.table.read(run, opened).drop(PART))
