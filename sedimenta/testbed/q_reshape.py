"""Landing, sheets, casts and the wide -> long path."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import (
    blank_to_null,
    cell_text,
    local_to_utc,
    to_date,
    to_double,
    to_int,
    utc_iso,
    year_from_position,
)
from sedimenta.operators import reshape
from sedimenta.session import scratch_path
from sedimenta.plans.reports import report_rows
from sedimenta.sources.landing import load_landing, table_counts
from sedimenta.sources.registry import LandingSource
from sedimenta.sources.sinks import json_rows
from sedimenta.testbed import frames as fr
from sedimenta.testbed import sql as s
from sedimenta.testbed.registry import query

SHEET = ("planta", "hoja", "base")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "landing_load",
    s.with_(*s.CELLS_CTES)
    + """SELECT 'hojas_' || base AS fuente, etiqueta, count(DISTINCT hoja) AS filas, count(valor) AS celdas FROM cells GROUP BY ALL""",
)
def _(spark, sf):
    """Sheets written as CSV, a landing source for each two years that occur and one that is missing, loaded back."""
    root = scratch_path(spark, "landing")
    cells = fr.cell_table(spark, sf)
    fr.wide_sheets(cells).withColumn("bloque", F.col("base")).write.partitionBy("bloque").option("header", True).csv(
        f"{root}/csv"
    )
    found = [r["base"] for r in cells.select("base").distinct().orderBy("base").collect()]
    sources = [LandingSource(f"hojas_{y}", f"/csv/bloque={y}") for y in found]
    tables = load_landing(spark, root, f"{root}/tables", [*sources, LandingSource("ausente", "/csv/ausente.csv")])
    out = None
    for name, sheet in tables.items():
        weeks = [c for c in sheet.columns if c.startswith("column")]
        filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in weeks), F.lit(0))
        part = sheet.groupBy("etiqueta").agg(F.count("*").alias("filas"), F.sum(filled).alias("celdas"))
        part = part.select(F.lit(name).alias("fuente"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "sheet_to_wide",
    s.with_(*s.CELLS_CTES)
    + """SELECT r.hoja, r.fila, r.etiqueta, format('column{:02d}', i) AS col_nombre, coalesce(c.valor, '') AS valor
FROM (SELECT DISTINCT hoja, fila, etiqueta FROM cells) r CROSS JOIN range(1, 107) n(i)
LEFT JOIN cells c ON c.hoja = r.hoja AND c.fila = r.fila AND c.columna = i + 1""",
)
def _(spark, sf):
    wide = reshape.sheet_to_wide(fr.sheet_cells(spark, sf))
    return reshape.unpivot_weeks(wide, ["hoja", "fila", "etiqueta"])


@query(
    "cell_to_text",
    """SELECT event_id,
  CASE WHEN value = trunc(value) THEN cast(cast(value AS BIGINT) AS VARCHAR)
       ELSE rtrim(rtrim(cast(cast(value AS DECIMAL(38,6)) AS VARCHAR), '0'), '.') END AS numero,
  CASE WHEN value / 7 = trunc(value / 7) THEN cast(cast(value / 7 AS BIGINT) AS VARCHAR)
       ELSE rtrim(rtrim(cast(cast(value / 7 AS DECIMAL(38,6)) AS VARCHAR), '0'), '.') END AS fraccion,
  strftime(ts, '%Y-%m-%d') AS fecha, event_type AS texto,
  CASE WHEN event_type = 'click' THEN '' ELSE event_type END AS vacio FROM events""",
)
def _(spark, sf):
    value = F.col("value")
    return fr.table(spark, sf, "events").select(
        "event_id",
        cell_text(number=value).alias("numero"),
        cell_text(number=value / 7).alias("fraccion"),
        cell_text(moment=F.col("ts")).alias("fecha"),
        cell_text(other=F.col("event_type")).alias("texto"),
        cell_text(other=F.when(F.col("event_type") != "click", F.col("event_type"))).alias("vacio"),
    )


@query("unpivot_weeks", s.with_(*s.CELLS_CTES) + "SELECT planta, hoja, base, etiqueta, col_nombre, valor FROM lng")
def _(spark, sf):
    return reshape.unpivot_weeks(fr.wide_sheets(fr.cell_table(spark, sf)), [*SHEET, "etiqueta"])


def _long(spark, sf):
    return fr.cell_table(spark, sf).select(
        *SHEET, "etiqueta", F.format_string("column%02d", F.col("columna") - 1).alias("col_nombre"), "valor"
    ).filter(F.col("valor").isNotNull())


@query(
    "week_headers",
    s.with_(*s.CELLS_CTES)
    + """SELECT planta, hoja, base, col_nombre, try_cast(valor AS INTEGER) AS semana_num FROM lng
WHERE trim(etiqueta) IN ('Semanas', 'Semana') AND try_cast(valor AS INTEGER) IS NOT NULL""",
)
def _(spark, sf):
    return reshape.week_headers(_long(spark, sf), SHEET)


@query(
    "metadata_pivot",
    s.with_(*s.CELLS_CTES)
    + """FROM (SELECT planta, hoja, base, format('column{:02d}', columna - 1) AS col_nombre, valor,
    ['fecha_str', 'operador_alias', 'tecnico_alias', 'hora_inicio', 'hora_termino'][fila - 2] AS campo FROM cells
  WHERE fila BETWEEN 3 AND 7 AND valor IS NOT NULL)
PIVOT (any_value(valor) FOR campo IN ('fecha_str', 'operador_alias', 'tecnico_alias', 'hora_inicio', 'hora_termino'))""",
)
def _(spark, sf):
    return reshape.metadata_pivot(_long(spark, sf), SHEET)


@query(
    "measurement_filter",
    s.with_(*s.CELLS_CTES)
    + """SELECT planta, hoja, base, format('column{:02d}', columna - 1) AS col_nombre, etiqueta AS punto_evaluacion,
  valor::DOUBLE AS concentracion_mg_m3 FROM cells WHERE fila >= 9""",
)
def _(spark, sf):
    return reshape.measurement_filter(_long(spark, sf), SHEET)


_BRONZE = s.with_(*s.BRONZE_CTES)


@query("wide_to_bronze", _BRONZE + "SELECT * FROM brz")
def _(spark, sf):
    return reshape.wide_to_bronze(
        fr.wide_sheets(fr.cell_table(spark, sf)), sheet=["hoja"], base_year="base", weeks_in_first_year=fr.WEEKS
    ).drop("_bronce_fuente", "_bronce_loaded_at")


@query(
    "bronze_union",
    _BRONZE + "SELECT *, 'snap_' || planta || '_' || (anio - (anio - 1995) % 2) AS _bronce_fuente FROM brz",
)
def _(spark, sf):
    """Every sheet is its own source; several sheets share a plant."""
    wide = fr.wide_sheets(fr.cell_table(spark, sf)).withColumn("_fuente", F.concat(F.lit("snap_"), F.col("hoja"))).drop("hoja")
    return reshape.wide_to_bronze(
        wide, sheet=["_fuente"], source="_fuente", base_year="base", weeks_in_first_year=fr.WEEKS
    ).drop("_bronce_loaded_at")


@query(
    "year_from_position",
    s.with_(*s.CELLS_CTES)
    + """SELECT hoja, col_nombre, cast(CASE WHEN cast(substring(col_nombre, 7) AS INTEGER) <= 53 THEN base ELSE base + 1 END AS INTEGER) AS anio,
count(*) AS celdas FROM lng GROUP BY ALL""",
)
def _(spark, sf):
    year = year_from_position(F.col("col_nombre"), F.col("base"), fr.WEEKS)
    return _long(spark, sf).groupBy("hoja", "col_nombre", year.alias("anio")).agg(F.count("*").alias("celdas"))


@query(
    "blank_to_null",
    s.with_(s.MED)
    + """SELECT planta, nullif(trim(coalesce(operador_alias, '')), '') AS operador, nullif(trim(coalesce(tecnico_alias, '')), '') AS tecnico,
nullif(trim(coalesce(CASE WHEN semana < 10 THEN '  ' ELSE hora_inicio END, '')), '') AS hora, count(*) AS filas FROM med GROUP BY ALL""",
)
def _(spark, sf):
    hour = F.when(F.col("semana") < 10, "  ").otherwise(F.col("hora_inicio"))
    return (
        fr.bronze(spark, sf)
        .groupBy(
            "planta",
            blank_to_null(F.col("operador_alias")).alias("operador"),
            blank_to_null(F.col("tecnico_alias")).alias("tecnico"),
            blank_to_null(hour).alias("hora"),
        )
        .agg(F.count("*").alias("filas"))
    )


# texts of many shapes made from every line item
_SHAPES = """CASE l_linenumber WHEN 1 THEN cast(l_quantity AS VARCHAR) WHEN 2 THEN '  ' || cast(l_discount AS VARCHAR) || ' '
 WHEN 3 THEN cast(l_partkey AS VARCHAR) WHEN 4 THEN cast(l_partkey AS VARCHAR) || 'd' WHEN 5 THEN '-' || cast(l_extendedprice AS VARCHAR)
 WHEN 6 THEN cast(l_partkey AS VARCHAR) || '.5' ELSE '1_' || lpad(cast(l_suppkey AS VARCHAR), 6, '0') END"""
_DATES = """CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%Y/%m/%d')
 WHEN 3 THEN strftime(l_shipdate, '%Y') WHEN 4 THEN strftime(l_shipdate, '%d-%m-%Y') WHEN 5 THEN strftime(l_shipdate, ' %Y-%m-%d 10:30:00')
 WHEN 6 THEN strftime(l_shipdate, '%Y-13-%d') ELSE l_returnflag END"""


@query(
    "safe_casts",
    f"""SELECT l_orderkey, l_linenumber, texto, try_cast(texto AS INTEGER) AS entero, try_cast(texto AS DOUBLE) AS numero,
try_cast(dia AS DATE) AS fecha FROM (SELECT l_orderkey, l_linenumber, {_SHAPES} AS texto, {_DATES} AS dia FROM lineitem)""",
)
def _(spark, sf):
    line = F.col("l_linenumber")

    def text(c):
        return F.col(c).cast("string")

    shapes = (
        F.when(line == 1, text("l_quantity"))
        .when(line == 2, F.concat(F.lit("  "), text("l_discount"), F.lit(" ")))
        .when(line == 3, text("l_partkey"))
        .when(line == 4, F.concat(text("l_partkey"), F.lit("d")))
        .when(line == 5, F.concat(F.lit("-"), text("l_extendedprice")))
        .when(line == 6, F.concat(text("l_partkey"), F.lit(".5")))
        .otherwise(F.concat(F.lit("1_"), F.lpad(text("l_suppkey"), 6, "0")))
    )

    def day(pattern):
        return F.date_format("l_shipdate", pattern)

    dates = (
        F.when(line == 1, day("yyyy-MM-dd"))
        .when(line == 2, day("yyyy/MM/dd"))
        .when(line == 3, day("yyyy"))
        .when(line == 4, day("dd-MM-yyyy"))
        .when(line == 5, day(" yyyy-MM-dd 10:30:00"))
        .when(line == 6, day("yyyy-'13'-dd"))
        .otherwise(F.col("l_returnflag"))
    )
    return (
        fr.table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", shapes.alias("texto"), dates.alias("dia"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "texto",
            to_int(F.col("texto")).alias("entero"),
            to_double(F.col("texto")).alias("numero"),
            to_date(F.col("dia")).alias("fecha"),
        )
    )


@query("utc_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS instante FROM events")
def _(spark, sf):
    return fr.table(spark, sf, "events").select("event_id", utc_iso(F.col("ts")).alias("instante"))


@query(
    "local_to_utc",
    """SELECT event_id, strftime((ts AT TIME ZONE 'America/Santiago') AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.000Z') AS instante FROM events""",
)
def _(spark, sf):
    return fr.table(spark, sf, "events").select("event_id", local_to_utc(F.col("ts"), "America/Santiago").alias("instante"))


@query("table_counts", "\nUNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}" for t in TABLES))
def _(spark, sf):
    return table_counts({t: fr.table(spark, sf, t) for t in TABLES})


@query(
    "report_json_rows",
    s.with_(*s.M2_CTES)
    + """SELECT cast(to_json({'planta': planta, 'anio': anio, 'semanas_medidas': semanas_medidas, 'puntos_medidos': puntos_medidos,
 'concentracion_promedio_mg_m3': concentracion_promedio_mg_m3, 'concentracion_max_mg_m3': concentracion_max_mg_m3,
 'concentracion_min_mg_m3': concentracion_min_mg_m3, 'registros_sobre_limite': registros_sobre_limite,
 'total_registros': total_registros, 'pct_sobre_limite': pct_sobre_limite, 'limite_interno_mg_m3': limite_interno_mg_m3}) AS VARCHAR) AS json FROM m2""",
)
def _(spark, sf):
    return json_rows(report_rows("concentracion_anual", {"M00002": fr.mart(spark, sf, "M00002")}, ordered=False))
