"""Numbers of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sedimenta.session import scratch_path


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, with underscores before them until the frame has no such column (case ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, order: list[Column], group: list[str] | None = None, number: str = "number", label: str = "ordered") -> DataFrame:
    """Adds `number`: the 0-based place of each row by `order`, within its `group` if given (NULL is a group too).

    Rows are range-partitioned by group and order, sorted in their partitions and written to the shared folder
    with their place, so the order cannot change between the two readings. Each partition's rows are counted
    per group; a row's number is its place plus the rows of its group in earlier partitions. Only one count for each
    partition (and group) is summed: at the driver without groups, by a window over the counts with groups.
    A group may span any number of partitions. Rows that are equal in all of `order` come in any order.
    """
    spark, group = df.sparkSession, group or []
    at, part, first, before = free_names(df, "at", "part", "first", "before")
    keys = [F.col(f"`{g}`").asc_nulls_first() for g in group] + order
    path = scratch_path(spark, label)
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id())
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path).withColumn(part, F.shiftright(at, 33).cast("int"))
    counts = rows.groupBy(part, *[F.col(f"`{g}`") for g in group]).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias(first))
    if group:
        earlier = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    else:
        sums, total = [], 0
        for r in sorted(counts.collect(), key=lambda r: r[part]):
            sums.append((r[part], r[first], total))
            total += r["n"]
        counts = spark.createDataFrame(sums, f"`{part}` int, `{first}` long, `{before}` long")
    counts = counts.select(*[F.col(f"`{c}`").alias(f"{c} of counts") for c in [part, *group, first, before]])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`{c} of counts`")) for c in [part, *group]]
    place = F.col(f"`{at}`") - F.col(f"`{first} of counts`") + F.col(f"`{before} of counts`")
    return rows.join(counts, reduce(Column.__and__, same)).select(*[F.col(f"`{c}`") for c in df.columns], place.alias(number))


def pages(df: DataFrame, order: str, size: int = 512) -> DataFrame:
    """`(pagina, primero, ultimo, filas)`: the ids of each page of `size` rows by ascending `order`, pages from 0.

    Rows without an id are on no page. A page is read back by its bounds, which the scan gets as a filter.
    """
    rows = df.select(F.col(order).alias("id")).filter(F.col("id").isNotNull())
    page = F.floor(F.col("numero") / F.lit(size)).cast("long").alias("pagina")
    bounds = F.min("id").alias("primero"), F.max("id").alias("ultimo"), F.count(F.lit(1)).alias("filas")
    return numbered(rows, [F.col("id").asc()], None, "numero", "pages").groupBy(page).agg(*bounds)


def read_page(df: DataFrame, order: str, page: Row) -> DataFrame:
    """The rows from a page's first to its last id, in order: at most a page's size if ids are unique."""
    return df.filter(F.col(order).between(page["primero"], page["ultimo"])).orderBy(order)
