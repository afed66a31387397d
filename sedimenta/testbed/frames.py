"""Driver tables -> domain frames. The SQL twins are in `sql.py`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.functions.text import number_text
from sedimenta.operators.reshape import pivot_cells
from sedimenta.plans import marts, silver
from sedimenta.session import scratch_path
from sedimenta.sources.seeds import band_seed

FIRST_YEAR = 1995
WEEKS = 53


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the footer once, as a catalogue would keep it."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Long measurements of every line item."""
    day = F.dayofyear("l_shipdate")
    key, line = F.col("l_suppkey"), F.col("l_linenumber")
    operator = F.when(key % 7 == 0, F.lit("desconocido")).otherwise(F.concat(F.lit(" "), F.col("s_name")))
    technician = F.concat(F.lit("Supplier#"), F.lpad((key - key % 9).cast("string"), 9, "0"))
    located = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "supplier"), key == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return located.select(
        F.col("n_name").alias("planta"),
        F.concat(F.lit("P"), (F.col("l_partkey") % 20).cast("string")).alias("punto_evaluacion"),
        F.year("l_shipdate").alias("anio"),
        (F.floor((day - 1) / 7) + 1).cast("int").alias("semana"),
        (F.col("l_quantity") / 10).alias("concentracion_mg_m3"),
        F.col("l_shipdate").cast("date").alias("fecha"),
        F.when(line < 7, operator).alias("operador_alias"),
        F.when(line < 6, technician).alias("tecnico_alias"),
        F.concat(F.lpad((line + 7).cast("string"), 2, "0"), F.lit(":00")).alias("hora_inicio"),
        F.concat(F.lpad((line + 8).cast("string"), 2, "0"), F.lit(":30")).alias("hora_termino"),
    )


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Alias catalogue from the suppliers, every tenth row twice."""
    key = F.col("s_suppkey")
    copies = F.sequence(F.lit(1), F.when(key % 10 == 0, 2).otherwise(1))
    return (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_name").alias("alias_fuente"),
            key.cast("string").alias("dni"),
            F.lit("RUN").alias("tipo_dni"),
            F.col("n_name").alias("dni_pais_emisor"),
            F.concat(F.lit("Persona "), key.cast("string")).alias("nombre_completo"),
            F.when(key % 9 == 0, "tecnico").otherwise("operador").alias("tipo_persona"),
            F.explode(copies).alias("_copy"),
        )
        .drop("_copy")
    )


def persons(spark: SparkSession, sf: str) -> DataFrame:
    return silver.entity_person(aliases(spark, sf))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return silver.entity_session(bronze(spark, sf))


def mart(spark: SparkSession, sf: str, name: str, ordered: bool = False) -> DataFrame:
    facts, bands = bronze(spark, sf), band_seed(spark)
    if name == "M00002":
        return marts.annual_summary(facts, bands, ordered)
    people = (aliases(spark, sf), persons(spark, sf))
    if name == "M00001":
        return marts.over_limit_latest(facts, sessions(spark, sf), *people, bands, ordered)
    if name == "M00003":
        return marts.historic_peak(facts, *people, bands, ordered)
    return marts.latest_session_all(facts, sessions(spark, sf), *people, bands, ordered)


def stored_points(spark: SparkSession, sf: str) -> DataFrame:
    """The highest concentration and the header values of every point and week, kept in the shared folder for the query that asks."""
    points = (
        bronze(spark, sf)
        .groupBy("planta", "anio", "semana", "punto_evaluacion")
        .agg(
            F.max("concentracion_mg_m3").alias("c"),
            F.max("fecha").alias("fecha"),
            F.max(F.trim("operador_alias")).alias("op"),
            F.max("tecnico_alias").alias("tec"),
            F.max("hora_inicio").alias("hi"),
            F.max("hora_termino").alias("ht"),
        )
    )
    path = scratch_path(spark, "points")
    points.write.parquet(path)
    return spark.read.schema(points.schema).parquet(path)


def cell_table(spark: SparkSession, sf: str) -> DataFrame:
    """`(planta, hoja, base, fila, columna, etiqueta, valor)`: sheets of two years per plant.

    Row 1 is a title, row 2 the week numbers, rows 3-8 the headers, then one
    row per point with the highest concentration of each week.
    """
    year, week = F.col("anio"), F.col("semana")
    base = year - (year - FIRST_YEAR) % 2
    column = (year - base) * WEEKS + week + 1
    # the facts are read once, down to a row per point and week; bodies, headers and week rows come from these
    measured = stored_points(spark, sf)
    tag = [F.col("planta"), F.concat_ws("_", "planta", base.cast("string")).alias("hoja"), base.alias("base")]

    body = measured.select(
        *tag,
        (F.substring("punto_evaluacion", 2, 10).cast("int") + 9).alias("fila"),
        column.alias("columna"),
        F.col("punto_evaluacion").alias("etiqueta"),
        number_text("c").alias("valor"),
    )

    def row(number: int, label: str, value):
        return F.struct(F.lit(number).alias("fila"), F.lit(label).alias("etiqueta"), value.cast("string").alias("valor"))

    per_week = measured.groupBy("planta", "anio", "semana").agg(
        *[F.max(c).alias(c) for c in ("fecha", "op", "tec", "hi", "ht")]
    )
    headers = per_week.select(
        *tag,
        column.alias("columna"),
        F.inline(
            F.array(
                row(3, "Fecha medición", F.col("fecha")),
                row(4, "Operador planta", F.col("op")),
                row(5, "Técnico higiene", F.col("tec")),
                row(6, "Hora inicio", F.col("hi")),
                row(7, "Hora termino", F.col("ht")),
                row(8, "Tratamiento tph", week + 1100),
            )
        ),
    ).select("planta", "hoja", "base", "fila", "columna", "etiqueta", "valor")
    sheets = per_week.select(*tag).distinct()
    weeks = sheets.select(
        "*", F.lit(2).alias("fila"), F.explode(F.sequence(F.lit(2), F.lit(2 * WEEKS + 1))).alias("columna"), F.lit("Semanas").alias("etiqueta")
    ).withColumn("valor", ((F.col("columna") - 2) % WEEKS + 1).cast("string"))
    return body.unionByName(headers).unionByName(weeks)


def sheet_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same cells as a workbook holds them: labels are the cells of column 1."""
    cells = cell_table(spark, sf)
    labels = cells.select("hoja", "fila", F.col("etiqueta").alias("valor")).distinct()
    titles = cells.select("hoja").distinct().select("hoja", F.lit(1).alias("fila"), F.lit("Polvo respirable").alias("valor"))
    first = labels.unionByName(titles).withColumn("columna", F.lit(1))
    return cells.select("hoja", "fila", "columna", "valor").unionByName(first)


def wide_sheets(cells: DataFrame) -> DataFrame:
    """`(planta, hoja, base, etiqueta, column01..column106)`, text cells; two years of weeks wide."""
    return pivot_cells(cells, ["planta", "hoja", "base", "etiqueta"], 2 * WEEKS)


def centroids(spark: SparkSession, sf: str) -> DataFrame:
    """One question vector per label: the mean of its vectors, to six decimals."""
    means = (
        table(spark, sf, "embeddings")
        .select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    )
    ordered = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("v"))
    return ordered.select(F.col("label").alias("query_id"), F.transform("v", lambda e: e["x"]).alias("embedding"))
