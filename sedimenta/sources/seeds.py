"""Reference tables: bands and the alias catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.operators.lookup import local_rows
from sedimenta.sources import fixed_values as fv

BANDS_SCHEMA = (
    "nivel int, concentracion_min_mg_m3 double, concentracion_max_mg_m3 double, "
    "color string, etiqueta string, es_sobre_limite_interno boolean"
)
ALIASES_SCHEMA = (
    "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string, "
    "nombre_completo string, tipo_persona string"
)


def band_seed(spark: SparkSession) -> DataFrame:
    """The band table as a local relation, so its exact size is known to the planner."""
    return local_rows(spark, fv.BANDS, BANDS_SCHEMA)


def read_bands(spark: SparkSession, path: str) -> DataFrame:
    """A band table from a headered CSV with the declared schema."""
    return spark.read.schema(BANDS_SCHEMA).option("header", True).csv(path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """The alias catalogue (alias -> person) from a headered CSV; ids stay text."""
    return spark.read.schema(ALIASES_SCHEMA).option("header", True).csv(path)
