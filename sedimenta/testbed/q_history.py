"""Snapshots, keys and incremental loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sedimenta.functions import content_hash, number_texts, surrogate_key
from sedimenta.operators import history
from sedimenta.plans import silver
from sedimenta.session import scratch_path
from sedimenta.sources.snapshot_store import SnapshotStore
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import ORACLE, query

FIRST, SECOND = datetime(2026, 1, 5), datetime(2026, 1, 12)
CHECKED = ["p_name", "p_brand", "p_retailprice"]


def _loads(spark, sf):
    """First load: the parts without those of size 50; second load: all, with every tenth price changed."""
    part = fr.table(spark, sf, "part").select("p_partkey", *CHECKED, "p_size")
    changed = F.when(F.col("p_partkey") % 10 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
    return part.filter("p_size < 50"), part.withColumn("p_retailprice", changed)


def _versions(spark, sf):
    first, second = _loads(spark, sf)
    return history.scd2_snapshot(history.scd2_first(first, ["p_partkey"], FIRST), second, ["p_partkey"], CHECKED, SECOND)


_SCD = """WITH old AS (SELECT p_partkey, p_name, p_brand, p_retailprice, p_size FROM part WHERE p_size < 50),
new AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice, p_size FROM part),
v AS (
  SELECT o.*, '2026-01-05' AS desde, '2026-01-05' AS visto, CASE WHEN n.p_retailprice <> o.p_retailprice THEN '2026-01-12' END AS hasta
  FROM old o LEFT JOIN new n USING (p_partkey)
  UNION ALL
  SELECT n.*, '2026-01-12', '2026-01-12', NULL FROM new n LEFT JOIN old o USING (p_partkey)
  WHERE o.p_partkey IS NULL OR o.p_retailprice <> n.p_retailprice)
"""


def _dated(versions):
    return versions.select(
        "p_partkey",
        *CHECKED,
        "p_size",
        F.date_format(history.VALID_FROM, "yyyy-MM-dd").alias("desde"),
        F.date_format(history.UPDATED_AT, "yyyy-MM-dd").alias("visto"),
        F.date_format(history.VALID_TO, "yyyy-MM-dd").alias("hasta"),
    )


@query("scd2_snapshot", _SCD + "SELECT * FROM v")
def _(spark, sf):
    return _dated(_versions(spark, sf))


@query("scd2_snapshot_buckets", ORACLE["scd2_snapshot"])
def _(spark, sf):
    """The same through a stored table: open versions in buckets, closed ones in a partition that no later load reads."""
    store = SnapshotStore(spark, scratch_path(spark, "versiones"), ["p_partkey"], CHECKED, buckets=16)
    for source, run, before, now in zip(_loads(spark, sf), ("w1", "w2"), (None, "w1"), (FIRST, SECOND)):
        store.load(source, run, before, now)
    return _dated(store.versions("w2"))


@query(
    "scd2_grown_columns",
    """SELECT p_partkey, p_retailprice, NULL AS p_semana, '2026-01-05' AS desde, '2026-01-12' AS hasta FROM part WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey, p_retailprice, NULL, '2026-01-05', NULL FROM part WHERE p_size % 3 > 0
UNION ALL SELECT p_partkey, p_retailprice, p_size, '2026-01-12', NULL FROM part WHERE p_size % 3 = 0""",
)
def _(spark, sf):
    """The second load brings a new check column, filled for some keys."""
    part = fr.table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    first = history.scd2_first(part.drop("p_size"), ["p_partkey"], FIRST)
    week = F.when(F.col("p_size") % 3 == 0, F.col("p_size"))
    grown = part.select("p_partkey", "p_retailprice", week.alias("p_semana"))
    return history.scd2_snapshot(first, grown, ["p_partkey"], ["p_retailprice", "p_semana"], SECOND).select(
        "p_partkey",
        "p_retailprice",
        "p_semana",
        F.date_format(history.VALID_FROM, "yyyy-MM-dd").alias("desde"),
        F.date_format(history.VALID_TO, "yyyy-MM-dd").alias("hasta"),
    )


@query("scd2_current", _SCD + "SELECT p_partkey, p_name, p_brand, p_retailprice, p_size FROM v WHERE hasta IS NULL")
def _(spark, sf):
    return history.scd2_current(_versions(spark, sf))


@query(
    "scd2_frozen_key",
    """SELECT p_partkey, p_retailprice, CASE WHEN p_size < 50 THEN '2026-01-05' ELSE '2026-01-12' END AS desde FROM (
  SELECT p_partkey, p_size, CASE WHEN p_size < 50 THEN p_retailprice ELSE p_retailprice + 1 END AS p_retailprice FROM part)""",
)
def _(spark, sf):
    """Check column = key: known keys keep their first values, only new keys come in."""
    part = fr.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    first = history.scd2_first(part.filter("p_size < 50"), ["p_partkey"], FIRST)
    later = part.withColumn("p_retailprice", F.col("p_retailprice") + 1)
    return history.scd2_snapshot(first, later, ["p_partkey"], ["p_partkey"], SECOND).select(
        "p_partkey", "p_retailprice", F.date_format(history.VALID_FROM, "yyyy-MM-dd").alias("desde")
    )


@query(
    "surrogate_key",
    f"SELECT l_orderkey, l_linenumber, {s.skey('l_orderkey', 'l_linenumber', 'l_returnflag', 'nullif(l_linestatus, $$O$$)')} AS huella FROM lineitem",
)
def _(spark, sf):
    status = F.nullif(F.col("l_linestatus"), F.lit("O"))
    return fr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", surrogate_key("l_orderkey", "l_linenumber", "l_returnflag", status).alias("huella")
    )


@query(
    "content_hash",
    f"""SELECT l_orderkey, l_linenumber, {s.skey('l_quantity', 'l_discount', 'l_extendedprice', 'cast(l_shipdate AS DATE)')} AS huella,
{s.skey('fino', 'enorme', 'raro')} AS huella_larga FROM (SELECT *, l_linenumber / 4096 + l_quantity AS fino, l_quantity * 1e15 AS enorme,
CASE l_linenumber WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN '-inf'::DOUBLE WHEN 4 THEN 0 ELSE -1 / (1 << (9 + l_linenumber)) END AS raro
FROM lineitem)""",
)
def _(spark, sf):
    """Doubles are hashed by a text that keeps every digit; also tiny, huge and special ones."""
    line = F.col("l_linenumber")
    odd = F.when(line == 1, "NaN").when(line == 2, "Infinity").when(line == 3, "-Infinity").when(line == 4, "-0.0").cast("double")
    items = fr.table(spark, sf, "lineitem").withColumns(
        {
            "fino": line / 4096 + F.col("l_quantity"),
            "enorme": F.col("l_quantity") * 1e15,
            "raro": F.coalesce(odd, -1 / F.pow(F.lit(2.0), line + 9)),
        }
    )
    texts = {"n": number_texts("l_quantity", "l_discount", "l_extendedprice"), "l": number_texts("fino", "enorme", "raro")}
    items = items.select("l_orderkey", "l_linenumber", "l_shipdate", *[t.alias(n) for n, t in texts.items()])
    numbers, long = ([F.col(n)[i] for i in range(3)] for n in texts)
    return items.select(
        "l_orderkey",
        "l_linenumber",
        content_hash(*numbers, F.col("l_shipdate").cast("date")).alias("huella"),
        content_hash(*long).alias("huella_larga"),
    )


_OLD = 1999


@query(
    "incremental_insert_only",
    s.with_(s.MED)
    + f"""SELECT DISTINCT {s.skey(*silver.MEASUREMENT)} AS huella_registro, planta, punto_evaluacion, anio, semana FROM med n
WHERE NOT EXISTS (SELECT 1 FROM med o WHERE o.anio <= {_OLD} AND o.planta = n.planta AND o.punto_evaluacion = n.punto_evaluacion
  AND o.anio = n.anio AND o.semana = n.semana)""",
)
def _(spark, sf):
    facts = fr.bronze(spark, sf)
    loaded = silver.relation_measurement(facts.filter(F.col("anio") <= _OLD))
    new = history.insert_only(silver.relation_measurement(facts), loaded)
    return new.select("huella_registro", *silver.MEASUREMENT)


_VERSIONS = f"""det AS (SELECT anio, {s.skey(*silver.MEASUREMENT)} AS huella_registro,
  {s.skey('concentracion_mg_m3', 'fecha', 'hora_inicio', 'hora_termino')} AS _huella_contenido, concentracion_mg_m3, fecha FROM med),
tgt AS (SELECT * FROM det WHERE anio <= {_OLD})"""


@query(
    "incremental_append_versions",
    s.with_(s.MED, _VERSIONS)
    + """SELECT huella_registro, _huella_contenido, concentracion_mg_m3, fecha FROM det WHERE _huella_contenido NOT IN (
  SELECT _huella_contenido FROM tgt WHERE huella_registro IN (SELECT huella_registro FROM det))""",
)
def _(spark, sf):
    facts = fr.bronze(spark, sf)
    loaded = silver.detail_measurement(facts.filter(F.col("anio") <= _OLD))
    new = history.append_versions(silver.detail_measurement(facts), loaded)
    return new.select("huella_registro", "_huella_contenido", "concentracion_mg_m3", "fecha")


@query(
    "incremental_append_correlated",
    s.with_(s.MED, _VERSIONS)
    + """SELECT huella_registro, _huella_contenido, concentracion_mg_m3, fecha FROM det
WHERE (huella_registro, _huella_contenido) NOT IN (SELECT huella_registro, _huella_contenido FROM tgt)""",
)
def _(spark, sf):
    facts = fr.bronze(spark, sf)
    loaded = silver.detail_measurement(facts.filter(F.col("anio") <= _OLD))
    new = history.append_versions(silver.detail_measurement(facts), loaded, correlated=True)
    return new.select("huella_registro", "_huella_contenido", "concentracion_mg_m3", "fecha")
