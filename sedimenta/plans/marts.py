"""Gold marts: one per business question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numbers import ratio_to_limit, round_half_up
from sedimenta.operators.lookup import band_lookup, internal_limit
from sedimenta.operators.people import with_people
from sedimenta.operators.ranking import keep_latest, peak_per_group

# Band columns shown in the marts and the two limit states.
BAND_COLUMNS = {"nivel": "nivel_semaforo", "color": "color_semaforo", "etiqueta": "etiqueta_semaforo"}
OVER, UNDER = "sobre_limite", "bajo_limite"


def limit_status(value: Column, limit: Column) -> Column:
    """Strictly above the limit or not; exactly the limit is under."""
    return F.when(value > limit, OVER).otherwise(UNDER)


def with_limit_and_band(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Limit, ratio and band columns of measurements."""
    limit = internal_limit(bands).scalar()
    banded = band_lookup(df.withColumn("limite_interno_mg_m3", limit), bands, "concentracion_mg_m3", BAND_COLUMNS)
    return banded.withColumn("veces_sobre_limite", ratio_to_limit(F.col("concentracion_mg_m3"), F.col("limite_interno_mg_m3")))


_TAIL = ("limite_interno_mg_m3", *BAND_COLUMNS.values())
_POINT = ("planta", "punto_evaluacion", "anio", "semana", "concentracion_mg_m3", "veces_sobre_limite")
_WHEN = ("fecha", "hora_inicio", "hora_termino")


def _highest_first() -> list[Column]:
    """By concentration; the other columns split equal values, so no sorted partition holds all of one value."""
    return [F.col("concentracion_mg_m3").desc_nulls_last(), *[F.col(c) for c in (*_POINT[:4], *_WHEN)]]


def over_limit_latest(
    bronze: DataFrame, sessions: DataFrame, aliases: DataFrame, persons: DataFrame, bands: DataFrame, ordered: bool = True
) -> DataFrame:
    """M00001: points over the internal limit in the latest session of their own plant.

    Sessions come from silver, which never deletes: a plant whose latest session
    is gone from bronze has no rows.
    """
    over = bronze.filter(F.col("concentracion_mg_m3") > internal_limit(bands).scalar())
    current = keep_latest(over, sessions, ["planta"])
    out = with_limit_and_band(with_people(current, aliases, persons), bands).select(
        *_POINT, *_WHEN, "operador", "tecnico", *_TAIL
    )
    return out.orderBy(*_highest_first()) if ordered else out


def summary_rows(yearly: DataFrame, limit: Column) -> DataFrame:
    """The shown columns of yearly sums: `(planta, anio, semanas_medidas, puntos_medidos, suma, maximo, minimo, sobre, filas)`."""
    return yearly.select(
        "planta",
        "anio",
        "semanas_medidas",
        F.when(F.col("semanas_medidas") == 1, "semana medida").otherwise("semanas medidas").alias("semanas_label"),
        "puntos_medidos",
        F.when(F.col("puntos_medidos") == 1, "punto").otherwise("puntos").alias("puntos_label"),
        round_half_up(F.col("suma") / F.col("filas"), 3).alias("concentracion_promedio_mg_m3"),
        round_half_up(F.col("maximo"), 3).alias("concentracion_max_mg_m3"),
        round_half_up(F.col("minimo"), 3).alias("concentracion_min_mg_m3"),
        F.col("sobre").alias("registros_sobre_limite"),
        F.col("filas").alias("total_registros"),
        round_half_up(F.col("sobre") * F.lit(100.0) / F.col("filas"), 1).alias("pct_sobre_limite"),
        limit.alias("limite_interno_mg_m3"),
    )


def annual_summary(bronze: DataFrame, bands: DataFrame, ordered: bool = True) -> DataFrame:
    """M00002: yearly statistics of each plant.

    Two levels: the first collapses rows to (plant, year, week, point) with
    map-side combine, so no shuffle carries a whole plant; the distinct counts
    then run over those few rows instead of an expanded copy of the facts.
    """
    value = F.col("concentracion_mg_m3")
    limit = internal_limit(bands).scalar()
    cells = (
        bronze.filter(value.isNotNull())
        .groupBy("planta", "anio", "semana", "punto_evaluacion")
        .agg(
            F.sum(value).alias("_sum"),
            F.max(value).alias("_max"),
            F.min(value).alias("_min"),
            F.count_if(value > limit).alias("_over"),
            F.count("*").alias("_rows"),
        )
    )
    out = summary_rows(
        cells.groupBy("planta", "anio").agg(
            F.count_distinct("semana").alias("semanas_medidas"),
            F.count_distinct("punto_evaluacion").alias("puntos_medidos"),
            F.sum("_sum").alias("suma"),
            F.max("_max").alias("maximo"),
            F.min("_min").alias("minimo"),
            F.sum("_over").alias("sobre"),
            F.sum("_rows").alias("filas"),
        ),
        limit,
    )
    if not ordered:
        return out
    return out.orderBy(F.col("pct_sobre_limite").desc_nulls_last(), F.col("concentracion_promedio_mg_m3").desc_nulls_last())


def historic_peak(
    bronze: DataFrame, aliases: DataFrame, persons: DataFrame, bands: DataFrame, ordered: bool = True
) -> DataFrame:
    """M00003: the highest measurement ever of each plant, with people and their ids."""
    named = with_people(peak_per_group(bronze), aliases, persons, with_ids=True)
    out = with_limit_and_band(named, bands).select(
        *_POINT, *_WHEN, "operador", "operador_dni", "tecnico", "tecnico_dni", *_TAIL
    )
    return out.orderBy(F.col("planta").asc_nulls_last()) if ordered else out


def latest_session_all(
    bronze: DataFrame, sessions: DataFrame, aliases: DataFrame, persons: DataFrame, bands: DataFrame, ordered: bool = True
) -> DataFrame:
    """M00004: every measurement of the latest session over all plants, over and under the limit."""
    current = keep_latest(bronze, sessions)
    out = (
        with_limit_and_band(with_people(current, aliases, persons), bands)
        .withColumn("estado_limite", limit_status(F.col("concentracion_mg_m3"), F.col("limite_interno_mg_m3")))
        .select(*_POINT, "estado_limite", *_WHEN, "operador", "tecnico", *_TAIL)
    )
    return out.orderBy(*_highest_first()) if ordered else out
