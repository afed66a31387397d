"""Hot keys: a third of all rows and more on one key must not end in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import governance as gov
from sedimenta.operators import history
from sedimenta.operators.people import with_people
from sedimenta.plans import silver

# forces shuffle joins and makes small partitions count as skewed
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df) -> tuple[int, str]:
    """Row count and the plan as executed."""
    counted = df.groupBy().agg(F.count("*").alias("n"), F.max(F.xxhash64(*df.columns)))
    rows = counted.collect()[0]["n"]
    return rows, counted._jdf.queryExecution().executedPlan().toString()


def test_hot_content_is_split(skewed):
    n = 60000
    hot = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string"))
    batch = skewed.range(0, n, 1, 6).select(
        F.md5(F.col("id").cast("string")).alias("huella_registro"), F.md5(hot).alias("_huella_contenido"), F.md5(F.col("id").cast("string")).alias("x")
    )
    target = skewed.range(0, 300, 1, 3).select(
        F.md5((F.col("id") * 3 + 2).cast("string")).alias("huella_registro"), F.md5((F.col("id") * 3 + 2).cast("string")).alias("_huella_contenido")
    )
    rows, plan = final_plan(history.append_versions(batch, target))
    assert rows == n - 300
    assert "skew=true" in plan


def test_hot_alias_is_split(skewed):
    n = 60000
    alias = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 500).cast("string")))
    facts = skewed.range(0, n, 1, 6).select(
        F.lit("A").alias("planta"),
        F.col("id").cast("string").alias("punto_evaluacion"),
        F.lit(2025).alias("anio"),
        F.lit(1).alias("semana"),
        F.lit(1.0).alias("concentracion_mg_m3"),
        F.lit(None).cast("date").alias("fecha"),
        F.lit("08").alias("hora_inicio"),
        F.md5(F.col("id").cast("string")).alias("hora_termino"),
        alias.alias("operador_alias"),
        F.lit(None).cast("string").alias("tecnico_alias"),
    )
    names = skewed.range(0, 500, 1, 2).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("alias_fuente"))
    aliases = names.unionByName(skewed.range(1).select(F.lit("hot").alias("alias_fuente"))).select(
        "alias_fuente",
        F.col("alias_fuente").alias("dni"),
        F.lit("RUN").alias("tipo_dni"),
        F.lit("CL").alias("dni_pais_emisor"),
        F.col("alias_fuente").alias("nombre_completo"),
        F.lit("operador").alias("tipo_persona"),
    )
    named = with_people(facts, aliases, silver.entity_person(aliases))
    assert named.filter("operador IS NULL").isEmpty()
    rows, plan = final_plan(named)
    assert rows == n
    assert "skew=true" in plan


def test_hot_plant_is_split_when_grants_are_many(skewed):
    n = 60000
    plant = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = skewed.range(0, n, 1, 6).select(plant.alias("planta"), F.md5(F.col("id").cast("string")).alias("x"))
    granted = skewed.range(0, n, 1, 3).select(
        F.lit("u").alias("user_id"), F.lit("planta").alias("dimension"), F.col("id").cast("string").alias("valor")
    )
    granted = granted.unionByName(skewed.range(1).select(F.lit("u").alias("user_id"), F.lit("planta").alias("dimension"), F.lit("hot").alias("valor")))
    seen, plan = final_plan(gov.governed(rows, granted, "u", {"planta": "planta"}))
    assert seen == n
    assert "skew=true" in plan
