"""History: snapshots, insert-only loads, append-only versions.

Plain Parquet has no MERGE, so every operator returns the next state or the
rows to append; `sources.sinks` decides how they are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import surrogate_key
from sedimenta.operators.lookup import distinct_for_join

# Technical columns of a snapshot.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
TECHNICAL = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def _moment(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    test = F.lit(True)
    for a, b in zip(left, right):
        test = test & a.eqNullSafe(b)
    return test


def scd2_first(source: DataFrame, key: Sequence[str], now: datetime | Column) -> DataFrame:
    """Open versions of a first load."""
    moment = _moment(now)
    return source.select(
        "*",
        surrogate_key(*key, moment).alias(SCD_ID),
        moment.alias(UPDATED_AT),
        moment.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )


def scd2_snapshot(
    versions: DataFrame, source: DataFrame, key: Sequence[str], check_cols: Sequence[str], now: datetime | Column
) -> DataFrame:
    """Next full set of versions, `check` strategy.

    A source row whose (key, check values) is not open yet is inserted; an open
    version whose key came with other check values is closed. Keys missing from
    the source stay open. When the check columns are just the key, known keys
    never change: only new ones are inserted.

    All joins are semi or anti joins, so repeated keys never multiply, and the
    build sides are reduced to distinct keys first. Columns new to the source
    (a sheet grows by one column per week) are added, NULL in old versions, and may be
    check columns at once. Closing a version sets its end only.
    """
    moment = _moment(now)
    compared = list(dict.fromkeys([*key, *check_cols]))
    grown = {c: F.lit(None).cast(source.schema[c].dataType) for c in source.columns if c not in versions.columns}
    versions = versions.withColumns(grown) if grown else versions
    open_rows = versions.filter(F.col(VALID_TO).isNull())
    closed_rows = versions.filter(F.col(VALID_TO).isNotNull())

    have = open_rows.select(*[F.col(c).alias(f"_h_{c}") for c in compared]).distinct()
    fresh = source.join(have, _same([F.col(c) for c in compared], [F.col(f"_h_{c}") for c in compared]), "left_anti")
    opened = scd2_first(fresh, key, moment)
    if set(compared) == set(key):
        return versions.unionByName(opened, allowMissingColumns=True)

    arrived = source.select(*[F.col(c).alias(f"_a_{c}") for c in compared]).distinct()
    arrived_keys = arrived.select(*[F.col(f"_a_{c}").alias(f"_k_{c}") for c in key]).distinct()
    still_same = _same([F.col(c) for c in compared], [F.col(f"_a_{c}") for c in compared])
    known_key = _same([F.col(c) for c in key], [F.col(f"_k_{c}") for c in key])
    # one pass over the open versions: which keep their values, which lost them, which did not come
    marked = open_rows.join(arrived.withColumn("_same", F.lit(True)), still_same, "left").join(
        arrived_keys.withColumn("_known", F.lit(True)), known_key, "left"
    )
    superseded = F.col("_same").isNull() & F.col("_known")
    kept = marked.select(
        *[c for c in versions.columns if c != VALID_TO],
        F.when(superseded, moment).alias(VALID_TO),
    )
    return closed_rows.unionByName(kept).unionByName(opened, allowMissingColumns=True)


def scd2_current(versions: DataFrame) -> DataFrame:
    """Open versions without the technical columns."""
    return versions.filter(F.col(VALID_TO).isNull()).drop(*TECHNICAL)


def insert_only(batch: DataFrame, target: DataFrame | None, key: str = "huella_registro") -> DataFrame:
    """Batch rows whose key is not in the target yet; known keys are never updated."""
    if target is None:
        return batch
    return batch.join(distinct_for_join(target, key), key, "left_anti")


def append_versions(
    batch: DataFrame,
    target: DataFrame | None,
    key: str = "huella_registro",
    content: str = "_huella_contenido",
    correlated: bool = False,
) -> DataFrame:
    """Batch rows whose content is not known yet among the target rows of the batch's keys.

    By default the test ignores which key the content belongs to: content equal
    to that of another key in the batch also suppresses the row. `correlated`
    compares (key, content) pairs instead. Both sides of every join may have a
    hot key: build sides are distinct, probe sides are split at run time.
    """
    if target is None:
        return batch
    if correlated:
        return batch.join(distinct_for_join(target, key, content), [key, content], "left_anti")
    touched = target.select(key, content).join(distinct_for_join(batch, key), key, "left_semi")
    return batch.join(distinct_for_join(touched, content), content, "left_anti")


def version_columns(now: datetime | Column) -> list[Column]:
    """`valid_from`, open `valid_to` and the first version number."""
    return [
        _moment(now).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(1).alias("version_seq"),
    ]
