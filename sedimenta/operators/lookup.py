"""Lookups in small sides and value ranges.

No operator collects a side or hints a broadcast: frames stay lazy, and AQE chooses broadcast or shuffle from the
sizes it measures, splitting skewed partitions of a join's own shuffles. A join on the keys of an
aggregate below it adopts the aggregate's partitioning instead and a hot key on the other side would stay in one
task, so build sides are grouped by `grouped_for_join`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """A local relation from a few driver rows (its statistics are exact)."""
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [[] for _ in struct]
    arrow = to_arrow_schema(struct)
    table = pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=struct)


def grouped_for_join(df: DataFrame, *keys: str) -> GroupedData:
    """Groups by the keys, in a partitioning no join on those keys can adopt."""
    return df.groupBy(*keys, F.xxhash64(*keys).alias("_spread"))


def distinct_for_join(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys for the build side of a join, see `grouped_for_join`."""
    return df.select(*keys, F.xxhash64(*keys).alias("_spread")).distinct().select(*keys)


def internal_limit(bands: DataFrame) -> DataFrame:
    """One row: the lowest bound among the bands flagged as over the limit."""
    return bands.filter("es_sobre_limite_interno").agg(F.min("concentracion_min_mg_m3").alias("mg_m3"))


def band_lookup(df: DataFrame, bands: DataFrame, value: str, columns: dict[str, str], cells: int = 1024) -> DataFrame:
    """Left range lookup: bands with min <= value < max (open top when max is NULL), NaN above every number.

    `columns` maps band column -> output name. Any number of bands, overlapping or not, as an equi-join on value
    cells: the finite span of the bands is cut in equal cells, a band is repeated for the cells it touches and a
    value goes to one cell. Both are clamped to the span by the same monotone formula, so every match meets in
    a cell and the exact bounds are tested there.
    """
    low, high = F.col("concentracion_min_mg_m3"), F.col("concentracion_max_mg_m3")
    span = bands.agg(F.min(low).alias("from"), F.greatest(F.max(low), F.max(high)).alias("to")).select(
        "from", ((F.col("to") - F.col("from")) / cells).alias("width")
    )
    start, width = span.select("from").scalar(), span.select("width").scalar()

    def cell(v: Column) -> Column:
        position = F.when(F.isnan(v), F.lit(cells)).when(width > 0, F.floor((v - start) / width)).otherwise(F.lit(0))
        return F.greatest(F.lit(0), F.least(F.lit(cells), position)).cast("int")

    last = F.when(high.isNull(), F.lit(cells)).otherwise(cell(high))
    pieces = bands.filter(low.isNotNull() & (high.isNull() | (low <= high))).select(
        low.alias("_low"),
        high.alias("_high"),
        *[F.col(source).alias(f"_out_{source}") for source in columns],
        F.explode(F.sequence(cell(low), last)).alias("_cell"),
    )
    probe = F.col(value)
    joined = df.withColumn("_probe", F.when(probe.isNotNull(), cell(probe))).join(
        pieces,
        (F.col("_probe") == F.col("_cell"))
        & (probe >= F.col("_low"))
        & (F.col("_high").isNull() | (probe < F.col("_high"))),
        "left",
    )
    return joined.select(*df.columns, *[F.col(f"_out_{s}").alias(name) for s, name in columns.items()])
