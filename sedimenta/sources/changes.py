"""Which sheets changed since an earlier run: one content digest per sheet, whatever the order of its rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.lookup import local_rows
from sedimenta.sources.sinks import read_if_exists

_LOADS = "fuente string, huella string, corrida string"


def sheet_digests(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """`(fuente, huella)`: row count, two sums of row hashes, and the column names of each sheet; one aggregate per sheet.

    The same rows in another order, or in other files, have the same digest; a repeated row counts each time. NULL and the empty text
    differ, and so does a value that moved to another column.
    """

    def one(name: str, sheet: DataFrame) -> DataFrame:
        cells = [x for c in sheet.columns for x in (F.col(f"`{c}`").isNull(), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))]
        hashes = sheet.select(*[F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)").alias(f"h{seed}") for seed in (1, 2)])
        sums = [F.coalesce(F.sum(h), F.lit(0)).cast("string") for h in ("h1", "h2")]
        parts = [F.count(F.lit(1)).cast("string"), *sums, F.md5(F.lit("\x1f".join(sheet.columns)))]
        return hashes.agg(F.concat_ws("/", *parts).alias("huella")).select(F.lit(name).alias("fuente"), "huella")

    return reduce(DataFrame.unionByName, [one(name, sheet) for name, sheet in sheets.items()])


@dataclass(frozen=True)
class Loads:
    """For each source the digest of its sheet and the run that loaded it: one entry per declared source."""

    digests: dict[str, str]
    runs: dict[str, str]

    @classmethod
    def read(cls, spark: SparkSession, path: str | None) -> Loads:
        rows = read_if_exists(spark, path) if path else None
        found = [] if rows is None else rows.collect()
        return cls({r["fuente"]: r["huella"] for r in found}, {r["fuente"]: r["corrida"] for r in found})

    def after(self, sheets: Mapping[str, DataFrame], run: str) -> Loads:
        """The state with the given sheets: those with the same digest keep their run, the others belong to `run`."""
        now = {r["fuente"]: r["huella"] for r in sheet_digests(sheets).collect()} if sheets else {}
        return Loads(now, {s: self.runs[s] if self.digests.get(s) == d else run for s, d in now.items()})

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(s, d, self.runs[s]) for s, d in sorted(self.digests.items())]
        local_rows(spark, rows, _LOADS).coalesce(1).write.mode("overwrite").parquet(path)
