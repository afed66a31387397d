"""Marts, silver models, joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import ratio_to_limit
from sedimenta.operators.lookup import band_lookup, internal_limit
from sedimenta.operators.people import with_people
from sedimenta.operators.ranking import keep_latest, latest_session, peak_per_group
from sedimenta.plans import marts, silver
from sedimenta.plans.annual import AnnualStates
from sedimenta.session import scratch_path
from sedimenta.sources.seeds import band_seed
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import ORACLE, query


@query("m1_over_limit_latest", s.with_(*s.M1_CTES) + "SELECT * FROM m1")
def _(spark, sf):
    return fr.mart(spark, sf, "M00001", ordered=True)


@query("m2_annual_summary", s.with_(*s.M2_CTES) + "SELECT * FROM m2")
def _(spark, sf):
    return fr.mart(spark, sf, "M00002", ordered=True)


@query("m2_annual_from_states", ORACLE["m2_annual_summary"])
def _(spark, sf):
    """The history up to 1996 as one load, the rest as another; the summary reads their states."""
    limit, facts = internal_limit(band_seed(spark)).scalar(), fr.bronze(spark, sf)
    states = AnnualStates(spark, scratch_path(spark, "anual"))
    states.load(facts.filter("anio <= 1996"), "r1", limit)
    states.load(facts.filter("anio > 1996"), "r2", limit)
    return states.summary(limit)


@query("m3_historic_peak", s.with_(*s.M3_CTES) + "SELECT * FROM m3")
def _(spark, sf):
    return fr.mart(spark, sf, "M00003", ordered=True)


@query("m4_latest_session_all", s.with_(*s.M4_CTES) + "SELECT * FROM m4")
def _(spark, sf):
    return fr.mart(spark, sf, "M00004", ordered=True)


@query(
    "internal_limit",
    s.with_(s.MED, s.BANDS, s.LIMIT)
    + "SELECT planta, mg_m3, count(*) AS sobre FROM med CROSS JOIN lim WHERE concentracion_mg_m3 > mg_m3 GROUP BY ALL",
)
def _(spark, sf):
    limit = internal_limit(band_seed(spark)).scalar()
    over = fr.bronze(spark, sf).filter(F.col("concentracion_mg_m3") > limit)
    return over.groupBy("planta").agg(F.count("*").alias("sobre")).select("planta", limit.alias("mg_m3"), "sobre")


@query(
    "seed_bands",
    s.with_(s.MED, s.BANDS)
    + """SELECT nivel, color, etiqueta, concentracion_min_mg_m3, concentracion_max_mg_m3, es_sobre_limite_interno, count(planta) AS registros
FROM bands LEFT JOIN med ON concentracion_mg_m3 >= concentracion_min_mg_m3
  AND (concentracion_mg_m3 < concentracion_max_mg_m3 OR concentracion_max_mg_m3 IS NULL) GROUP BY ALL""",
)
def _(spark, sf):
    """The seed with how many measurements fall in each of its bands."""
    bands = band_seed(spark)
    counts = (
        band_lookup(fr.bronze(spark, sf), bands, "concentracion_mg_m3", {"nivel": "nivel"})
        .groupBy("nivel")
        .agg(F.count("*").alias("registros"))
    )
    return bands.join(counts, "nivel", "left").fillna(0, ["registros"]).select(
        "nivel",
        "color",
        "etiqueta",
        "concentracion_min_mg_m3",
        "concentracion_max_mg_m3",
        "es_sobre_limite_interno",
        "registros",
    )


@query(
    "band_lookup",
    s.with_(s.MED, s.BANDS)
    + """SELECT planta, nivel, etiqueta, count(*) AS registros, min(concentracion_mg_m3) AS desde, max(concentracion_mg_m3) AS hasta
FROM med LEFT JOIN bands ON concentracion_mg_m3 >= concentracion_min_mg_m3
  AND (concentracion_mg_m3 < concentracion_max_mg_m3 OR concentracion_max_mg_m3 IS NULL) GROUP BY ALL""",
)
def _(spark, sf):
    banded = band_lookup(
        fr.bronze(spark, sf), band_seed(spark), "concentracion_mg_m3", {"nivel": "nivel", "etiqueta": "etiqueta"}
    )
    return banded.groupBy("planta", "nivel", "etiqueta").agg(
        F.count("*").alias("registros"), F.min("concentracion_mg_m3").alias("desde"), F.max("concentracion_mg_m3").alias("hasta")
    )


@query(
    "limit_status",
    s.with_(s.MED, s.BANDS, s.LIMIT)
    + """SELECT planta, punto_evaluacion, CASE WHEN concentracion_mg_m3 > mg_m3 THEN 'sobre_limite' ELSE 'bajo_limite' END AS estado_limite,
count(*) AS registros FROM med CROSS JOIN lim GROUP BY ALL""",
)
def _(spark, sf):
    limit = internal_limit(band_seed(spark)).scalar()
    status = marts.limit_status(F.col("concentracion_mg_m3"), limit)
    return fr.bronze(spark, sf).groupBy("planta", "punto_evaluacion", status.alias("estado_limite")).agg(F.count("*").alias("registros"))


@query(
    "times_over_limit",
    s.with_(s.MED, s.BANDS, s.LIMIT)
    + f"""SELECT concentracion_mg_m3, {s.rounded('concentracion_mg_m3 / mg_m3', 2)} AS veces_sobre_limite, count(*) AS registros
FROM med CROSS JOIN lim GROUP BY ALL""",
)
def _(spark, sf):
    limit = internal_limit(band_seed(spark)).scalar()
    counted = fr.bronze(spark, sf).groupBy("concentracion_mg_m3").agg(F.count("*").alias("registros"))
    return counted.select("concentracion_mg_m3", ratio_to_limit(F.col("concentracion_mg_m3"), limit).alias("veces_sobre_limite"), "registros")


@query(
    "latest_session_per_group",
    s.with_(s.MED, s.SESSIONS)
    + """SELECT med.planta, punto_evaluacion, med.anio, med.semana, concentracion_mg_m3, fecha FROM med
JOIN (SELECT planta, max(anio * 100 + semana) AS m FROM sessions GROUP BY planta) u
  ON med.planta = u.planta AND med.anio * 100 + med.semana = u.m""",
)
def _(spark, sf):
    return keep_latest(fr.bronze(spark, sf), fr.sessions(spark, sf), ["planta"]).select(
        "planta", "punto_evaluacion", "anio", "semana", "concentracion_mg_m3", "fecha"
    )


@query(
    "latest_session_global",
    s.with_(s.MED, s.SESSIONS)
    + """SELECT planta, punto_evaluacion, anio, semana, concentracion_mg_m3, fecha FROM med
WHERE anio * 100 + semana = (SELECT max(anio * 100 + semana) FROM sessions)""",
)
def _(spark, sf):
    return keep_latest(fr.bronze(spark, sf), fr.sessions(spark, sf)).select(
        "planta", "punto_evaluacion", "anio", "semana", "concentracion_mg_m3", "fecha"
    )


@query(
    "session_maximum",
    s.with_(s.MED, s.SESSIONS) + "SELECT planta, max(anio * 100 + semana) AS sesion_max FROM sessions GROUP BY planta",
)
def _(spark, sf):
    return latest_session(fr.sessions(spark, sf), ["planta"])


@query("alias_resolution", s.with_(*s.NAMED_ALL_CTES) + "SELECT * FROM named")
def _(spark, sf):
    return with_people(fr.bronze(spark, sf), fr.aliases(spark, sf), fr.persons(spark, sf))


@query("peak_per_group", s.with_(*s.PEAK_CTES) + "SELECT * FROM peak")
def _(spark, sf):
    return peak_per_group(fr.bronze(spark, sf))


def _silver(df):
    return df.drop("_silver_loaded_at", "valid_from", "valid_to")


_FROM = "'bronce_mediciones' AS _silver_fuente"


@query("entity_plant", s.with_(s.MED) + f"SELECT DISTINCT {s.skey('planta')} AS huella_registro, planta, {_FROM} FROM med")
def _(spark, sf):
    return _silver(silver.entity_plant(fr.bronze(spark, sf)))


@query(
    "entity_point",
    s.with_(s.MED)
    + f"SELECT DISTINCT {s.skey(*silver.POINT)} AS huella_registro, planta, punto_evaluacion, {_FROM} FROM med",
)
def _(spark, sf):
    return _silver(silver.entity_point(fr.bronze(spark, sf)))


@query(
    "entity_session",
    s.with_(s.MED) + f"SELECT DISTINCT {s.skey(*silver.SESSION)} AS huella_registro, planta, anio, semana, {_FROM} FROM med",
)
def _(spark, sf):
    return _silver(fr.sessions(spark, sf))


@query("entity_person", s.with_(s.ALIASES, s.PERSONS) + "SELECT *, 'semillas.personas_alias' AS _silver_fuente FROM persons")
def _(spark, sf):
    return _silver(fr.persons(spark, sf))


@query(
    "rel_measurement",
    s.with_(s.MED)
    + f"""SELECT DISTINCT {s.skey(*silver.MEASUREMENT)} AS huella_registro, {s.skey(*silver.POINT)} AS ent_punto_medicion_hk,
{s.skey(*silver.SESSION)} AS ent_sesion_medicion_hk, planta, punto_evaluacion, anio, semana, {_FROM} FROM med""",
)
def _(spark, sf):
    return _silver(silver.relation_measurement(fr.bronze(spark, sf)))


_PERSON = ("dni", "tipo_dni", "dni_pais_emisor")
_ROLE_CTE = f"""uni AS (
  SELECT planta, punto_evaluacion, anio, semana, who.rol, s_suppkey::VARCHAR AS dni, 'RUN' AS tipo_dni, n_name AS dni_pais_emisor
  FROM (SELECT planta, punto_evaluacion, anio, semana, unnest([
      {{'rol': 'operador', 'k': {s.ALIAS_NUMBER.format("operador_alias")}}}, {{'rol': 'tecnico', 'k': {s.ALIAS_NUMBER.format("tecnico_alias")}}}
    ]) AS who FROM med)
  JOIN supplier ON s_suppkey = who.k JOIN nation ON n_nationkey = s_nationkey)"""


@query(
    "rel_measurement_person",
    s.with_(s.MED, s.ALIASES, _ROLE_CTE)
    + f"""SELECT DISTINCT {s.skey(*silver.MEASUREMENT, 'rol', *_PERSON)} AS huella_registro, {s.skey(*silver.MEASUREMENT)} AS rel_medicion_hk,
{s.skey(*_PERSON)} AS ent_persona_hk, planta, punto_evaluacion, anio, semana, rol, dni, {_FROM} FROM uni""",
)
def _(spark, sf):
    return _silver(silver.relation_measurement_person(fr.bronze(spark, sf), fr.aliases(spark, sf)))


_DETAIL = f"""SELECT {s.skey(*silver.MEASUREMENT)} AS huella_registro,
{s.skey('concentracion_mg_m3', 'fecha', 'hora_inicio', 'hora_termino')} AS _huella_contenido,
concentracion_mg_m3, fecha, hora_inicio, hora_termino, 1 AS version_seq, {_FROM} FROM med"""


@query("detail_measurement", s.with_(s.MED) + _DETAIL)
def _(spark, sf):
    return _silver(silver.detail_measurement(fr.bronze(spark, sf)))
