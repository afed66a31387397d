"""Silver entities, relations and versioned details, keyed by hashes.

Each model is the batch derived from bronze (or the catalogue). Pass it through
`history.insert_only` / `history.append_versions` for an incremental run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import content_hash, surrogate_key
from sedimenta.functions.text import number_text
from sedimenta.operators.history import version_columns
from sedimenta.operators.people import PERSON_KEY, person_roles

# Business keys and the names of the sources.
PLANT = ("planta",)
POINT = ("planta", "punto_evaluacion")
SESSION = ("planta", "anio", "semana")
MEASUREMENT = ("planta", "punto_evaluacion", "anio", "semana")
FROM_BRONZE = "bronce_mediciones"
FROM_ALIASES = "semillas.personas_alias"


def _audit(source: str, now: datetime | Column | None) -> list[Column]:
    moment = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now).cast("timestamp"))
    return [moment.alias("_silver_loaded_at"), F.lit(source).alias("_silver_fuente")]


def _entity(df: DataFrame, key: Sequence[str], now: datetime | Column | None, source: str = FROM_BRONZE) -> DataFrame:
    return df.select(*key).distinct().select(surrogate_key(*key).alias("huella_registro"), *key, *_audit(source, now))


def entity_plant(bronze: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    return _entity(bronze, PLANT, now)


def entity_point(bronze: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    return _entity(bronze, POINT, now)


def entity_session(bronze: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    return _entity(bronze, SESSION, now)


def entity_person(aliases: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Distinct persons of the alias catalogue; a person with two names keeps both rows."""
    attributes = (*PERSON_KEY, "nombre_completo", "tipo_persona")
    return (
        aliases.select(*attributes)
        .distinct()
        .select(surrogate_key(*PERSON_KEY).alias("huella_registro"), *attributes, *_audit(FROM_ALIASES, now))
    )


def relation_measurement(bronze: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    return (
        bronze.select(*MEASUREMENT)
        .distinct()
        .select(
            surrogate_key(*MEASUREMENT).alias("huella_registro"),
            surrogate_key(*POINT).alias("ent_punto_medicion_hk"),
            surrogate_key(*SESSION).alias("ent_sesion_medicion_hk"),
            *MEASUREMENT,
            *_audit(FROM_BRONZE, now),
        )
    )


def relation_measurement_person(bronze: DataFrame, aliases: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    return person_roles(bronze, aliases).select(
        surrogate_key(*MEASUREMENT, "rol", *PERSON_KEY).alias("huella_registro"),
        surrogate_key(*MEASUREMENT).alias("rel_medicion_hk"),
        surrogate_key(*PERSON_KEY).alias("ent_persona_hk"),
        *MEASUREMENT,
        "rol",
        "dni",
        *_audit(FROM_BRONZE, now),
    )


def detail_measurement(bronze: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Attributes of every bronze row, with record key, content hash and version columns; no shuffle."""
    moment = F.current_timestamp() if now is None else now
    attributes = ("concentracion_mg_m3", "fecha", "hora_inicio", "hora_termino")
    return bronze.select(
        surrogate_key(*MEASUREMENT).alias("huella_registro"),
        content_hash(number_text(attributes[0]), *attributes[1:]).alias("_huella_contenido"),
        *attributes,
        *version_columns(moment),
        F.lit(FROM_BRONZE).alias("_silver_fuente"),
    )
