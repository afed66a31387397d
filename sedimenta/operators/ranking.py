"""Latest sessions, peaks and last-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.time import session_ordinal
from sedimenta.operators.lookup import grouped_for_join

# Rows of equal concentration: the later session wins, then the greater text.
PEAK_ORDER = (
    "concentracion_mg_m3",
    "anio",
    "semana",
    "punto_evaluacion",
    "fecha",
    "hora_inicio",
    "hora_termino",
    "operador_alias",
    "tecnico_alias",
)


def latest_session(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Greatest session ordinal, per group or over everything."""
    newest = F.max(session_ordinal(F.col("anio"), F.col("semana"))).alias("sesion_max")
    return grouped_for_join(sessions, *by).agg(newest).drop("_spread") if by else sessions.agg(newest)


def keep_latest(measurements: DataFrame, sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Measurements of the latest session.

    The year is compared on its own as well: where bronze is partitioned by
    `anio`, older partitions are not read at all.
    """
    ordinal = session_ordinal(F.col("anio"), F.col("semana"))
    latest = latest_session(sessions, by)
    if not by:
        newest = latest.scalar()
        return measurements.filter((F.col("anio") == F.floor(newest / 100)) & (ordinal == newest))
    oldest = latest.agg(F.min("sesion_max")).scalar()
    return (
        measurements.filter(F.col("anio") >= F.floor(oldest / 100))
        .withColumn("sesion_max", ordinal)
        .join(latest, [*by, "sesion_max"], "inner")
        .drop("sesion_max")
    )


def peak_per_group(measurements: DataFrame, by: Sequence[str] = ("planta",), order: Sequence[str] = PEAK_ORDER) -> DataFrame:
    """The greatest row of each group under `order`, all descending with NULLs last.

    First the highest value per group, a hash aggregate over two columns. Then
    only rows that reach it are read in full: the lowest of those values is a
    pushed-down filter, so files without a peak are skipped. Ties are settled by
    a struct maximum over the few rows left, combined on the map side.
    """
    value = order[0]
    grouped = grouped_for_join(measurements, *by).agg(F.max(value).alias("_top"))
    tops = grouped.filter(F.col("_top").isNotNull()).drop("_spread")
    lowest = tops.agg(F.min("_top")).scalar()
    keys = tops.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_top")
    same = F.col(value) == F.col("_top")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    reaching = measurements.filter(F.col(value) >= lowest).join(keys, same, "left_semi")
    row = F.struct(*[F.col(c) for c in order])
    return reaching.groupBy(*by).agg(F.max(row).alias("_peak")).select(*by, "_peak.*")


def last_n(df: DataFrame, by: Sequence[str], order: str, n: int) -> DataFrame:
    """The last `n` rows of each group; each task keeps at most `n` per group before the shuffle."""
    window = Window.partitionBy(*by).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")
