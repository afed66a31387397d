"""Landing: headered CSV sheets -> text tables."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.lookup import internal_limit, local_rows
from sedimenta.sources.registry import LANDING_SOURCES, LandingSource


def read_sheet(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A headered CSV with every column as text.

    Cells of one column mix numbers, dates and names, so nothing is inferred. A file is read by many tasks unless
    quoted cells may hold line breaks (`multiline`), which takes one task per file.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )


def resolve(location: str, root: str) -> str:
    """Declared locations, absolute or not, live under the root."""
    return f"{root.rstrip('/')}/{location.lstrip('/')}"


def open_landing(spark: SparkSession, root: str, sources: Iterable[LandingSource] = LANDING_SOURCES) -> dict[str, DataFrame]:
    """The sources that exist under `root`; missing files are skipped, not an error."""
    found: dict[str, DataFrame] = {}
    for source in sources:
        try:
            found[source.name] = read_sheet(spark, resolve(source.location, root), source.multiline)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def load_landing(
    spark: SparkSession, root: str, target: str, sources: Iterable[LandingSource] = LANDING_SOURCES
) -> dict[str, DataFrame]:
    """Replaces each landing table found under `root` and returns the written tables."""
    return write_landing(open_landing(spark, root, sources), target)


def write_landing(sheets: dict[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Replaces the landing tables of the given sheets."""
    written: dict[str, DataFrame] = {}
    for name, sheet in sheets.items():
        path = f"{target.rstrip('/')}/{name}"
        sheet.write.mode("overwrite").parquet(path)
        written[name] = sheet.sparkSession.read.parquet(path)
    return written


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """`(tabla, filas)` of all tables in one query, by name; a table that could not be opened keeps NULL.

    Each branch is a count without columns, answered from file footers and row batches.
    """
    counts: DataFrame | None = None
    frames = [df for df in tables.values() if df is not None]
    if not frames:
        raise ValueError("no table to count")
    spark = frames[0].sparkSession
    for name, df in sorted(tables.items()):
        if df is None:
            one = spark.range(1).select(F.lit(name).alias("tabla"), F.lit(None).cast("long").alias("filas"))
        else:
            one = df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def catalog_counts(spark: SparkSession, databases: Iterable[str] | None = None) -> DataFrame:
    """`(esquema, tabla, filas)` of the base tables of all databases; views and names starting with `_` are left out.

    A table that cannot be read gets NULL: tables are counted apart, so one failure spoils no other count.
    """
    rows: list[tuple[str, str, int | None]] = []
    for database in databases if databases is not None else [d.name for d in spark.catalog.listDatabases()]:
        for table in spark.catalog.listTables(database):
            if table.name.startswith("_") or table.isTemporary or table.tableType not in ("MANAGED", "EXTERNAL"):
                continue
            try:
                count = spark.table(f"`{database}`.`{table.name}`").count()
            except (PySparkException, Py4JJavaError):
                count = None
            rows.append((database, table.name, count))
    return local_rows(spark, sorted(rows, key=lambda r: r[:2]), "esquema string, tabla string, filas long")


def layer_diagnostics(table: DataFrame, order: Iterable[str], bands: DataFrame | None = None, sample: int = 5) -> DataFrame:
    """One row on a mart or snapshot: its columns, row count, the internal limit and the first rows as JSON.

    `order` fixes which rows the sample shows; NULL limit without bands.
    """
    keys = list(order)
    head = table.select(*keys, F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"}).alias("_row"))
    head = head.orderBy(*keys, "_row").limit(sample).withColumn("_k", F.struct(*keys, "_row"))
    shown = head.agg(F.transform(F.array_sort(F.collect_list("_k")), lambda k: k["_row"]).alias("muestra"))
    limit = F.lit(None).cast("double") if bands is None else internal_limit(bands).scalar()
    return table.agg(F.count("*").alias("filas")).select(
        F.array(*[F.lit(c) for c in table.columns]).alias("columnas"), "filas", limit.alias("limite_mg_m3"), shown.scalar().alias("muestra")
    )
