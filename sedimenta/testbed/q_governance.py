"""Governance, reports and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import governance as gov
from sedimenta.operators.lookup import local_rows
from sedimenta.plans import indicators, reports
from sedimenta.sources.registry import INDICATORS, REPORTS, RULES
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import query

AUDITOR = "auditor"


def members(spark, sf):
    """Groups of plants: every region holds its nations."""
    return (
        fr.table(spark, sf, "nation")
        .join(fr.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.lit("planta").alias("dimension"), F.col("r_name").alias("grupo"), F.col("n_name").alias("valor"))
    )


def grants(spark, sf):
    """One user per region with its group, one per nation with a plain value, an auditor with all groups."""
    regions, nations = fr.table(spark, sf, "region"), fr.table(spark, sf, "nation")

    def grant(df, user, dimension, value):
        return df.select(user.alias("user_id"), F.lit(dimension).alias("dimension"), value.alias("granted"))

    region, nation = F.col("r_name"), F.col("n_name")
    area = F.when(F.col("r_regionkey") % 2 == 0, "Seguridad ocupacional").otherwise("Medioambiente")
    return (
        grant(regions, F.concat(F.lit("jefe "), region), "planta", region)
        .unionByName(grant(regions, F.concat(F.lit("jefe "), region), "ambito", area))
        .unionByName(grant(nations, F.concat(F.lit("op "), nation), "planta", nation))
        .unionByName(grant(regions, F.lit(AUDITOR), "planta", region))
        .unionByName(local_rows(spark, [(AUDITOR, "ambito", "Todos")], gov.GRANTS_SCHEMA))
    )


def expanded(spark, sf):
    areas = gov.group_members(spark, {"ambito": {"Todos": ("Seguridad ocupacional", "Medioambiente")}})
    return gov.expand_grants(grants(spark, sf), members(spark, sf).unionByName(areas))


GRANTS = """mem AS (SELECT 'planta' AS dimension, r_name AS grupo, n_name AS valor FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'ambito', 'Todos', unnest(['Seguridad ocupacional', 'Medioambiente'])),
grt AS (SELECT 'jefe ' || r_name AS user_id, 'planta' AS dimension, r_name AS granted FROM region
  UNION ALL SELECT 'jefe ' || r_name, 'ambito', CASE WHEN r_regionkey % 2 = 0 THEN 'Seguridad ocupacional' ELSE 'Medioambiente' END FROM region
  UNION ALL SELECT 'op ' || n_name, 'planta', n_name FROM nation
  UNION ALL SELECT 'auditor', 'planta', r_name FROM region
  UNION ALL SELECT 'auditor', 'ambito', 'Todos'),
xp AS (SELECT DISTINCT user_id, grt.dimension, coalesce(valor, granted) AS valor
  FROM grt LEFT JOIN mem ON grt.dimension = mem.dimension AND granted = grupo)"""


@query("governance_expand", s.with_(GRANTS) + "SELECT * FROM xp")
def _(spark, sf):
    return expanded(spark, sf)


@query(
    "governance_filter",
    s.with_(*s.M2_CTES, GRANTS) + "SELECT m2.* FROM m2 WHERE planta IN (SELECT valor FROM xp WHERE user_id = 'jefe EUROPE' AND dimension = 'planta')",
)
def _(spark, sf):
    """What the head of a region sees of the annual summary; it has no `ambito`, so that dimension does not filter."""
    return gov.governed(fr.mart(spark, sf, "M00002"), expanded(spark, sf), "jefe EUROPE", {"planta": "planta"})


@query(
    "governance_fail_closed",
    s.with_(*s.M2_CTES, GRANTS)
    + """SELECT u AS user_id, (SELECT count(*) FROM m2 WHERE planta IN (SELECT valor FROM xp WHERE user_id = u AND dimension = 'planta')
  AND EXISTS (FROM xp WHERE user_id = u AND dimension = 'ambito' AND valor = 'Seguridad ocupacional')) AS filas
FROM (VALUES ('auditor'), ('jefe AFRICA'), ('jefe AMERICA'), ('op FRANCE'), ('nadie')) t(u)""",
)
def _(spark, sf):
    """With `ambito` required, users granted another one, or none at all, see nothing."""
    rows = fr.mart(spark, sf, "M00002").withColumn("ambito", F.when(F.col("total_registros") > 0, "Seguridad ocupacional"))
    allowed, out = expanded(spark, sf), None
    for user in (AUDITOR, "jefe AFRICA", "jefe AMERICA", "op FRANCE", "nadie"):
        seen = gov.governed(rows, allowed, user, {"planta": "planta", "ambito": "ambito"})
        one = seen.agg(F.count("*").alias("filas")).select(F.lit(user).alias("user_id"), "filas")
        out = one if out is None else out.unionByName(one)
    return out


_ALL_USERS = "SELECT DISTINCT user_id FROM xp UNION ALL SELECT 'nadie'"


@query(
    "governance_visible_counts",
    s.with_(*s.M2_CTES, GRANTS)
    + f"""SELECT user_id, (SELECT count(*) FROM m2 WHERE planta IN (SELECT valor FROM xp WHERE xp.user_id = u.user_id AND dimension = 'planta')
  AND CASE WHEN anio % 2 = 0 THEN 'Medioambiente' ELSE 'Seguridad ocupacional' END IN (SELECT valor FROM xp WHERE xp.user_id = u.user_id AND dimension = 'ambito')) AS filas
FROM ({_ALL_USERS}) u""",
)
def _(spark, sf):
    """Visible rows of every user, and of one without grants; even years belong to another area."""
    area = F.when(F.col("anio") % 2 == 0, "Medioambiente").otherwise("Seguridad ocupacional")
    allowed = expanded(spark, sf)
    users = allowed.select("user_id").unionByName(local_rows(spark, [("nadie",)], "user_id string"))
    rows = fr.mart(spark, sf, "M00002").withColumn("ambito", area)
    return gov.visible_counts(rows, allowed, users, {"planta": "planta", "ambito": "ambito"})


_RANK = "CASE {0} WHEN 'Público' THEN 0 WHEN 'Interno' THEN 1 WHEN 'Restringido' THEN 2 WHEN 'Solo gerencias' THEN 3 END"
_DOC_CLEARANCE = (
    "CASE WHEN n_chars % 5 = 0 THEN 'Público' WHEN n_chars % 5 = 1 THEN 'Interno' WHEN n_chars % 5 = 2 THEN 'Restringido' "
    "WHEN n_chars % 5 = 3 THEN 'Solo gerencias' ELSE 'otra' END"
)


@query(
    "governance_ordinal",
    f"""SELECT doc_id, clasificacion FROM (SELECT d.doc_id, {_DOC_CLEARANCE} AS clasificacion,
  CASE quality WHEN 1 THEN 'Restringido' WHEN 0 THEN 'Interno' END AS permitida FROM documents d LEFT JOIN labels USING (doc_id))
WHERE {_RANK.format('clasificacion')} <= {_RANK.format('permitida')}""",
)
def _(spark, sf):
    """Documents within the clearance their label gives; no label means no clearance."""
    rest = F.col("n_chars") % 5
    level = (
        F.when(rest == 0, "Público")
        .when(rest == 1, "Interno")
        .when(rest == 2, "Restringido")
        .when(rest == 3, "Solo gerencias")
        .otherwise("otra")
    )
    granted = F.when(F.col("quality") == 1, "Restringido").when(F.col("quality") == 0, "Interno")
    rows = (
        fr.table(spark, sf, "documents")
        .join(fr.table(spark, sf, "labels"), "doc_id", "left")
        .select("doc_id", level.alias("clasificacion"), granted.alias("permitida"))
    )
    return gov.cleared(rows, "clasificacion", F.col("permitida")).select("doc_id", "clasificacion")


@query(
    "context_paths",
    s.with_(GRANTS)
    + """SELECT a.user_id, 'ambito:::' || a.valor || '_._planta:::' || p.valor AS contexto FROM xp a
JOIN xp p ON a.user_id = p.user_id AND a.dimension = 'ambito' AND p.dimension = 'planta'""",
)
def _(spark, sf):
    return gov.context_paths(expanded(spark, sf))


def _marts(spark, sf):
    """Marts by id, built when a report asks for them."""

    class Marts(dict):
        def __missing__(self, name):
            return fr.mart(spark, sf, name)

    return Marts()


def _select(report_id: str, mart: str) -> str:
    columns = ", ".join(f"{mart}.{c}" for c in REPORTS[report_id].columns)
    return f"SELECT {columns} FROM {mart} WHERE planta IN (SELECT valor FROM xp WHERE user_id = 'auditor' AND dimension = 'planta')"


@query("report_annual", s.with_(*s.M2_CTES, GRANTS) + _select("concentracion_anual", "m2"))
def _(spark, sf):
    return reports.report("concentracion_anual", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query("report_annual_by_year", s.with_(*s.M2_CTES, GRANTS) + _select("concentracion_anual", "m2") + " AND anio = 1998")
def _(spark, sf):
    return reports.report("concentracion_anual", _marts(spark, sf), expanded(spark, sf), AUDITOR, anio=1998)


@query("report_exceedances", s.with_(*s.M1_CTES, GRANTS) + _select("excedencias_semana", "m1"))
def _(spark, sf):
    return reports.report("excedencias_semana", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query("report_peak", s.with_(*s.M3_CTES, GRANTS) + _select("peak_historico", "m3"))
def _(spark, sf):
    return reports.report("peak_historico", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query("report_peak_granted", s.with_(*s.M3_CTES, GRANTS) + _select("peak_historico", "m3").replace("'auditor'", "'jefe ASIA'"))
def _(spark, sf):
    """The same report for a user who sees one region."""
    return reports.report("peak_historico", _marts(spark, sf), expanded(spark, sf), "jefe ASIA")


_CATALOG = " UNION ALL ".join(
    f"SELECT '{r.id}' AS reporte_id, '{r.title}' AS nombre, {list(r.formats)} AS formatos" for r in REPORTS.values()
)


@query(
    "report_catalog",
    f"""SELECT user_id, reporte_id, nombre, formatos, habilitado_para_usuario
FROM (SELECT cast(c_custkey AS VARCHAR) AS user_id, c_mktsegment IN ('BUILDING', 'MACHINERY') AS habilitado_para_usuario FROM customer)
CROSS JOIN ({_CATALOG})""",
)
def _(spark, sf):
    """Customers as users: two segments may consume reports, the others only the indicators."""
    module = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "reportes").otherwise("kpis")
    permissions = fr.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), module.alias("modulo"), F.lit("consumir").alias("accion")
    )
    return reports.report_catalog(permissions)


_K1 = "planta, punto_evaluacion, concentracion_mg_m3 AS valor_actual, estado_limite, limite_interno_mg_m3, anio, semana FROM m4"
_K2 = "planta, anio, pct_sobre_limite AS valor_actual, registros_sobre_limite, total_registros, limite_interno_mg_m3 FROM m2"
_K3 = """planta, count(CASE WHEN estado_limite = 'sobre_limite' THEN 1 END) AS valor_actual, count(*) AS puntos_totales
FROM m4 GROUP BY planta"""


def _banded(select: str, ranges, threshold) -> str:
    cases = " ".join(
        "WHEN "
        + " AND ".join(
            [f"valor_actual >= {low}"] * (low is not None) + [f"valor_actual <= {high}"] * (high is not None)
        )
        + f" THEN '{level}'"
        for low, high, level in ranges
    )
    return f"SELECT *, CASE {cases} END AS nivel, valor_actual > {threshold} AS sobre_umbral FROM (SELECT {select})"


@query(
    "kpi_max_concentration",
    s.with_(*s.M4_CTES) + _banded(_K1, ((None, 1.99, "ok"), (2.0, 2.99, "warning"), (3.0, None, "critico")), 3.0),
)
def _(spark, sf):
    return indicators.indicator("concentracion-maxima-ultima-jornada", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query(
    "kpi_pct_over_limit",
    s.with_(*s.M2_CTES) + _banded(_K2, ((None, 4.9, "ok"), (5.0, 14.9, "warning"), (15.0, None, "critico")), 5.0),
)
def _(spark, sf):
    return indicators.indicator("pct-sobre-limite-anual", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query(
    "kpi_pct_over_limit_granted",
    s.with_(*s.M2_CTES, GRANTS)
    + _banded(
        _K2 + " WHERE planta IN (SELECT valor FROM xp WHERE user_id = 'jefe AFRICA' AND dimension = 'planta')",
        ((None, 4.9, "ok"), (5.0, 14.9, "warning"), (15.0, None, "critico")),
        5.0,
    ),
)
def _(spark, sf):
    """The same indicator for a user who sees one region."""
    return indicators.indicator("pct-sobre-limite-anual", _marts(spark, sf), expanded(spark, sf), "jefe AFRICA")


@query(
    "kpi_critical_points",
    s.with_(*s.M4_CTES) + _banded(_K3, ((None, 0, "ok"), (1, 2, "warning"), (3, None, "critico")), 0),
)
def _(spark, sf):
    return indicators.indicator("puntos-criticos-ultima-jornada", _marts(spark, sf), expanded(spark, sf), AUDITOR)


@query(
    "kpi_severity",
    s.with_(s.MED)
    + """SELECT nivel, count(*) AS registros, min(valor_actual) AS desde, max(valor_actual) AS hasta, count(CASE WHEN sobre_umbral THEN 1 END) AS sobre FROM ("""
    + _banded(
        "concentracion_mg_m3 * 0.995 AS valor_actual FROM med",
        ((None, 1.99, "ok"), (2.0, 2.99, "warning"), (3.0, None, "critico")),
        3.0,
    )
    + ") GROUP BY nivel",
)
def _(spark, sf):
    """Severity of every measurement; values between two ranges have no level."""
    rows = fr.bronze(spark, sf).select((F.col("concentracion_mg_m3") * 0.995).alias("valor_actual"))
    return (
        indicators.with_severity(rows, INDICATORS["concentracion-maxima-ultima-jornada"])
        .groupBy("nivel")
        .agg(
            F.count("*").alias("registros"),
            F.min("valor_actual").alias("desde"),
            F.max("valor_actual").alias("hasta"),
            F.count_if("sobre_umbral").alias("sobre"),
        )
    )


def _rule(number: int, ctes) -> None:
    rule = RULES[f"P0000{number}_M0000{number}"]

    @query(f"rule_p{number}", s.with_(*ctes) + f"SELECT {', '.join(rule.columns)} FROM m{number}")
    def _(spark, sf):
        return fr.mart(spark, sf, rule.mart).select(*rule.columns)


for _number, _ctes in enumerate((s.M1_CTES, s.M2_CTES, s.M3_CTES, s.M4_CTES), start=1):
    _rule(_number, _ctes)
