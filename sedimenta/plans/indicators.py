"""Governed indicators with severity bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.governance import governed
from sedimenta.operators.lookup import local_rows
from sedimenta.plans.marts import OVER
from sedimenta.sources.registry import INDICATORS, Indicator


def severity(value: Column, ranges: Sequence[tuple[float | None, float | None, str]]) -> Column:
    """Level of the first closed range that holds the value; None is an open end.

    The ranges are taken literally: a value between two of them (1.995) has no level.
    """
    level: Column | None = None
    for low, high, name in ranges:
        test = value.isNotNull()
        if low is not None:
            test &= value >= F.lit(float(low))
        if high is not None:
            test &= value <= F.lit(float(high))
        level = F.when(test, name) if level is None else level.when(test, name)
    return F.lit(None).cast("string") if level is None else level


def with_severity(df: DataFrame, indicator: Indicator) -> DataFrame:
    """Adds `nivel` and `sobre_umbral` (strictly above the threshold)."""
    value = F.col("valor_actual")
    return df.withColumn("nivel", severity(value, indicator.severity)).withColumn(
        "sobre_umbral", value > F.lit(float(indicator.threshold))
    )


def max_concentration(m00004: DataFrame) -> DataFrame:
    return m00004.select(
        "planta",
        "punto_evaluacion",
        F.col("concentracion_mg_m3").alias("valor_actual"),
        "estado_limite",
        "limite_interno_mg_m3",
        "anio",
        "semana",
    )


def pct_over_limit(m00002: DataFrame) -> DataFrame:
    return m00002.select(
        "planta",
        "anio",
        F.col("pct_sobre_limite").alias("valor_actual"),
        "registros_sobre_limite",
        "total_registros",
        "limite_interno_mg_m3",
    )


def critical_points(m00004: DataFrame) -> DataFrame:
    return m00004.groupBy("planta").agg(
        F.count_if(F.col("estado_limite") == OVER).alias("valor_actual"), F.count("*").alias("puntos_totales")
    )


# indicator -> (rows from its mart, order)
_ROWS = {
    "concentracion-maxima-ultima-jornada": (max_concentration, (("valor_actual", "desc"),)),
    "pct-sobre-limite-anual": (pct_over_limit, (("planta", "asc"), ("anio", "desc"))),
    "puntos-criticos-ultima-jornada": (critical_points, (("valor_actual", "desc"),)),
}


def indicator(indicator_id: str, marts: Mapping[str, DataFrame], expanded: DataFrame, user_id: str) -> DataFrame:
    """An indicator as `user_id` may see it: the mart is filtered before it is counted per plant."""
    if indicator_id not in INDICATORS:
        raise KeyError(f"unknown indicator: {indicator_id}")
    definition = INDICATORS[indicator_id]
    rows, order = _ROWS[indicator_id]
    visible = governed(marts[definition.mart], expanded, user_id, definition.dimensions)
    keys = [F.col(c).asc_nulls_last() if way == "asc" else F.col(c).desc_nulls_last() for c, way in order]
    return with_severity(rows(visible), definition).orderBy(*keys)


def display_columns(spark: SparkSession, indicator_id: str) -> DataFrame:
    """How the columns of an indicator are shown: label, order, format, unit."""
    rows = [
        (indicator_id, name, label, position, form, unit)
        for position, (name, label, form, unit) in enumerate(INDICATORS[indicator_id].display, start=1)
    ]
    return local_rows(spark, rows, "kpi_id string, campo string, etiqueta string, orden int, formato string, unidad string")
