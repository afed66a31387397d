"""The yearly summary kept up by loads: exact states that merge, so a new week is read alone.

A load leaves one row for each plant, year and week: a bit map of the points measured and, beside it, sum, extremes and counts. Bit
maps merge by `or`, the rest by sum and extremes; points get their place in the map from a dictionary that only grows. A summary
reads states, never the measurements of earlier loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.numbering import numbered
from sedimenta.plans.marts import summary_rows
from sedimenta.sources.sinks import read_if_exists
from sedimenta.sources.versioned import RUN

_STATES = (
    f"planta string, anio int, semana int, bloque long, puntos binary, suma double, maximo double, minimo double, sobre long, filas long, {RUN} string"
)
_POINTS = f"planta string, punto_evaluacion string, numero long, {RUN} string"


def week_states(bronze: DataFrame, points: DataFrame, limit: Column) -> DataFrame:
    """`(planta, anio, semana, bloque, puntos, suma, maximo, minimo, sobre, filas)` of the measured rows.

    `bloque` is the part of the bit map that a point's number falls in: every row counts in one, so sums over them are whole.
    """
    value, number = F.col("concentracion_mg_m3"), F.col("numero")
    # first by point, so no shuffle carries a whole plant and the dictionary is joined to few rows
    cells = (
        bronze.filter(value.isNotNull())
        .groupBy("planta", "anio", "semana", "punto_evaluacion")
        .agg(F.sum(value).alias("s"), F.max(value).alias("hi"), F.min(value).alias("lo"), F.count_if(value > limit).alias("o"), F.count(F.lit(1)).alias("n"))
    )
    known = points.select(F.col("planta").alias("_p"), F.col("punto_evaluacion").alias("_e"), "numero")
    placed = cells.join(known, F.col("planta").eqNullSafe(F.col("_p")) & (F.col("punto_evaluacion") == F.col("_e")), "left")
    return placed.groupBy("planta", "anio", "semana", F.bitmap_bucket_number(number).alias("bloque")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("puntos"),
        F.sum("s").alias("suma"),
        F.max("hi").alias("maximo"),
        F.min("lo").alias("minimo"),
        F.sum("o").alias("sobre"),
        F.sum("n").alias("filas"),
    )


def yearly_states(states: DataFrame) -> DataFrame:
    """The weeks' states put together by plant, year and part of the bit map, with a bit map of the weeks."""
    return states.groupBy("planta", "anio", "bloque").agg(
        F.bitmap_or_agg("puntos").alias("puntos"),
        F.bitmap_construct_agg(F.bitmap_bit_position("semana")).alias("semanas"),
        F.sum("suma").alias("suma"),
        F.max("maximo").alias("maximo"),
        F.min("minimo").alias("minimo"),
        F.sum("sobre").alias("sobre"),
        F.sum("filas").alias("filas"),
    )


class AnnualStates:
    """States and the dictionary of points under `base`, one folder per load. A load that is repeated replaces its own folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame | None:
        if read_if_exists(self.spark, f"{self.base}/{name}") is None:
            return None
        return self.spark.read.schema(schema).parquet(f"{self.base}/{name}")

    def states(self) -> DataFrame | None:
        return self._read("estados", _STATES)

    def points(self) -> DataFrame | None:
        return self._read("puntos", _POINTS)

    def load(self, rows: DataFrame, run: str, limit: Column) -> None:
        """Adds the rows of one load; rows of different loads are different measurements.

        New points are numbered after the known ones of their plant. Of earlier loads only the dictionary is read.
        """
        points = self.points()
        known = None if points is None else points.filter(F.col(RUN) != run).select("planta", "punto_evaluacion", "numero")
        seen = rows.filter(F.col("concentracion_mg_m3").isNotNull() & F.col("punto_evaluacion").isNotNull()).select("planta", "punto_evaluacion").distinct()
        if known is not None:
            old = known.select(F.col("planta").alias("_p"), F.col("punto_evaluacion").alias("_e"))
            seen = seen.join(old, F.col("planta").eqNullSafe(F.col("_p")) & (F.col("punto_evaluacion") == F.col("_e")), "left_anti")
        fresh = numbered(seen, [F.col("punto_evaluacion").asc()], ["planta"], "numero", "puntos")
        if known is not None:
            last = known.groupBy(F.col("planta").alias("_p")).agg(F.max("numero").alias("_last"))
            fresh = fresh.join(last, F.col("planta").eqNullSafe(F.col("_p")), "left")
            fresh = fresh.withColumn("numero", F.col("numero") + F.coalesce(F.col("_last"), F.lit(0)))
        fresh = fresh.select("planta", "punto_evaluacion", (F.col("numero") + 1).alias("numero"))
        fresh.write.mode("overwrite").parquet(f"{self.base}/puntos/{RUN}={run}")
        every = self.points().select("planta", "punto_evaluacion", "numero")
        week_states(rows, every, limit).write.mode("overwrite").parquet(f"{self.base}/estados/{RUN}={run}")

    def summary(self, limit: Column) -> DataFrame:
        """The rows of `marts.annual_summary` over all loads, from the states alone."""
        parts = yearly_states(self.states())
        yearly = parts.groupBy("planta", "anio").agg(
            F.bitmap_or_agg("semanas").alias("semanas"),
            F.sum(F.bitmap_count("puntos")).alias("puntos_medidos"),
            F.sum("suma").alias("suma"),
            F.max("maximo").alias("maximo"),
            F.min("minimo").alias("minimo"),
            F.sum("sobre").alias("sobre"),
            F.sum("filas").alias("filas"),
        )
        return summary_rows(yearly.withColumn("semanas_medidas", F.bitmap_count("semanas")), limit)
