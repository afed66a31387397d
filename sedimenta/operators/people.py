"""Alias -> person resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.keys import surrogate_key
from sedimenta.operators.lookup import grouped_for_join

# Roles and the business key of a person.
OPERATOR, TECHNICIAN = "operador", "tecnico"
PERSON_KEY = ("dni", "tipo_dni", "dni_pais_emisor")
MEASUREMENT = (
    "planta",
    "punto_evaluacion",
    "anio",
    "semana",
    "concentracion_mg_m3",
    "fecha",
    "hora_inicio",
    "hora_termino",
)


def alias_names(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """One row per alias: the name and id to show for each role.

    alias -> catalogue -> person by key hash; a name counts only for the role
    that is the person's type. Repeated catalogue rows collapse here, before
    anything large is joined. An alias whose catalogue row has no person gets NULLs.
    """
    linked = aliases.select("alias_fuente", surrogate_key(*PERSON_KEY).alias("_persona")).distinct()
    known = persons.select(F.col("huella_registro").alias("_persona"), "nombre_completo", "tipo_persona", "dni").distinct()
    role = F.col("tipo_persona")
    return (
        grouped_for_join(linked.join(known, "_persona", "left"), "alias_fuente")
        .agg(
            *[
                F.max(F.when(role == r, F.col(c))).alias(name)
                for r in (OPERATOR, TECHNICIAN)
                for c, name in (("nombre_completo", r), ("dni", f"{r}_dni"))
            ]
        )
        .drop("_spread")
    )


def with_people(
    measurements: DataFrame,
    aliases: DataFrame,
    persons: DataFrame,
    with_ids: bool = False,
    by: Sequence[str] = MEASUREMENT,
) -> DataFrame:
    """One row per distinct measurement with operator and technician (and their ids).

    The lookup has one row per alias, so neither join multiplies rows; the
    maximum over equal measurements is map-side combined.
    """
    names = alias_names(aliases, persons)
    out = measurements
    for role in (OPERATOR, TECHNICIAN):
        side = names.select(
            F.col("alias_fuente").alias(f"_{role}"), F.col(role).alias(f"_{role}_n"), F.col(f"{role}_dni").alias(f"_{role}_i")
        )
        out = out.join(side, F.trim(F.col(f"{role}_alias")) == F.col(f"_{role}"), "left")
    shown = []
    for role in (OPERATOR, TECHNICIAN):
        shown.append(F.max(f"_{role}_n").alias(role))
        if with_ids:
            shown.append(F.max(f"_{role}_i").alias(f"{role}_dni"))
    return out.groupBy(*by).agg(*shown)


def person_roles(bronze: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct (measurement, role, person); aliases outside the catalogue are dropped.

    Both roles come from one pass over bronze, and equal (measurement, role,
    alias) rows are merged before the join.
    """
    session = ("planta", "punto_evaluacion", "anio", "semana")
    roles = F.array(
        *[F.struct(F.lit(r).alias("rol"), F.trim(F.col(f"{r}_alias")).alias("alias")) for r in (OPERATOR, TECHNICIAN)]
    )
    present = (
        bronze.filter(F.col("operador_alias").isNotNull() | F.col("tecnico_alias").isNotNull())
        .select(*session, F.inline(roles))
        .filter(F.col("alias").isNotNull())
        .distinct()
    )
    catalogue = aliases.select(F.col("alias_fuente").alias("alias"), *PERSON_KEY).distinct()
    return present.join(catalogue, "alias", "inner").select(*session, "rol", *PERSON_KEY).distinct()
