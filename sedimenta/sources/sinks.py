"""Materialisation: views, insert-only and versioned appends, overwrites, report files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.chunks import development_view
from sedimenta.operators.history import append_versions, insert_only

REPORT_FORMATS = ("json", "csv", "parquet")

# Fixed value: vector size where none is configured.
DEFAULT_VECTOR_SIZE = 1536

DUMP_SCHEMA = (
    "regla_id string, fecha_creacion string, corrida_id string, medallon_id string, valido_hasta bigint, "
    "politica_vigencia string, dimensiones map<string,string>, dimensiones_en_texto array<string>, pii_estrategia string, "
    "pii_tokens map<string,string>, estrategia_olvido string, hash_contenido string, firma_hmac string, texto string, "
    "datos_negocio map<string,string>, chunk_clave string, firma_hmac_entrada string"
)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replaces a table. Give a path the plan does not read."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_new(df: DataFrame, path: str, key: str = "huella_registro") -> DataFrame:
    """Appends the rows whose key is new; running it again appends nothing."""
    spark = df.sparkSession
    insert_only(df, read_if_exists(spark, path), key).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def append_detail(df: DataFrame, path: str, correlated: bool = False) -> DataFrame:
    """Appends the detail rows whose content is new."""
    spark = df.sparkSession
    append_versions(df, read_if_exists(spark, path), correlated=correlated).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def ensure_vectors(spark: SparkSession, path: str, size: int | None = None) -> DataFrame:
    """The vector table, created empty if absent; size and metric are kept with the column."""
    known = read_if_exists(spark, path)
    if known is not None:
        return known
    kept = {"size": DEFAULT_VECTOR_SIZE if size is None else size, "distance": "cosine"}
    schema = T.StructType(
        [T.StructField("chunk_id", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()), metadata=kept)]
    )
    return write_table(spark.createDataFrame([], schema), path)


def write_chunk_dump(chunks: DataFrame, path: str) -> None:
    """The generated chunks for inspection, one JSON object per line."""
    development_view(chunks).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_chunk_dump(spark: SparkSession, path: str) -> DataFrame:
    """The dump back with its declared types."""
    return spark.read.schema(DUMP_SCHEMA).json(path)


def write_snapshot(counts: DataFrame, store: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """State before a run: table counts and the ids of the chunk store, read back."""
    return write_table(counts, f"{path}/tablas"), write_table(store.select("chunk_id"), f"{path}/chunks")


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULLs kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Writes a report in a known format."""
    if fmt not in REPORT_FORMATS:
        raise ValueError(f"unknown report format {fmt!r}; use one of {', '.join(REPORT_FORMATS)}")
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
