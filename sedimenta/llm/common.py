"""What the text operators share: reading tables, folds, Arrow blocks of bounded size, files for workers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.numbering import free_names
from sedimenta.session import scratch_path

#: Text bytes that a task turns into Python objects at a time.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(identity: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; NULL for a NULL id."""
    key = F.col(identity) if isinstance(identity, str) else identity
    return F.crc32(key.cast("string").cast("binary")) % parts


def held_out(identity: str | Column, parts: int, part: int) -> Column:
    """A row without an id is never held out, and never learned from either."""
    return F.coalesce(fold(identity, parts) == part, F.lit(False))


def learnable(identity: str | Column, parts: int, part: int) -> Column:
    return F.coalesce(fold(identity, parts) != part, F.lit(False))


def thinned(df: DataFrame, group: str, rows: int, hashed: Column) -> DataFrame:
    """The rows that a sample of `rows` of each group is taken from: some four times as many, by a hash.

    Groups are counted first, so that all tasks together offer a bounded number of rows, however many tasks there
    are. Groups of up to that size stay whole; NULL groups go.
    """
    counts = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n")).collect()
    if not counts:
        return df.filter(F.lit(False))
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[group], min(1.0, (4 * rows + 100) / r["n"]))])
    return df.filter(F.col(group).isNotNull() & (F.pmod(hashed, F.lit(1 << 30)) < share[F.col(group)] * (1 << 30)))


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about `limit` bytes; a longer text is a slice of its own.

    What a slice's work has freed goes back to the system before the next: kept by two workers it is much of an executor.
    """
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    number = np.cumsum(sizes) // limit
    edges = np.flatnonzero(np.diff(number)) + 1
    start = 0
    for end in (*edges.tolist(), batch.num_rows):
        if end > start:
            yield batch.slice(start, end - start)
            release()
        start = end


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """NULL reads as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def mapped(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict], text: str) -> DataFrame:
    """`work` gets a block of rows and gives the output columns of that block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                out = work(block)
                yield pa.record_batch([as_arrow(out[f.name], f.type) for f in arrow], schema=arrow)
        release()

    return df.mapInArrow(run, schema)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


#: Bits of the filter that goes before a join on ids: its size is fixed, whatever the number of ids.
FILTER_BITS = 1 << 22


def suspected(df: DataFrame, ids: DataFrame, identity: str, inside: bool = True) -> DataFrame:
    """The rows whose id may be among `ids`, or with `inside` false those whose id surely is not.

    A bit map of hashed ids, at most FILTER_BITS / 64 rows whatever `ids` has, is sent to the rows, so that a join
    with few ids need not shuffle the texts of all. `ids` should be stored, as it is read again by the join.
    """
    word, seen, bits, mark = free_names(df, "word", "seen", "bits", "mark")
    slot = F.pmod(F.xxhash64(F.col(f"`{identity}`").cast("long")), F.lit(FILTER_BITS))
    words = ids.select(slot.alias("slot")).selectExpr("slot div 64 AS w", "shiftleft(1L, cast(slot % 64 AS int)) AS b")
    words = words.groupBy(F.col("w").alias(word)).agg(F.bit_or("b").alias(bits))
    marked = df.withColumn(mark, slot).withColumn(seen, F.expr(f"`{mark}` div 64"))
    marked = marked.join(F.broadcast(words), F.col(seen) == F.col(word), "left")
    hit = F.expr(f"coalesce(shiftrightunsigned(`{bits}`, cast(`{mark}` % 64 AS int)) & 1L = 1L, false)")
    return marked.filter(hit if inside else ~hit).select([F.col(f"`{c}`") for c in df.columns])


def without(df: DataFrame, ids: DataFrame, identity: str) -> DataFrame:
    """The rows whose id is not among the stored `ids`; rows without an id stay."""
    [name] = free_names(df, "gone")
    gone = ids.select(F.col(f"`{identity}`").alias(name)).distinct()
    unsure = suspected(df, ids, identity)
    kept = unsure.join(gone, F.col(f"`{identity}`") == F.col(name), "left_anti")
    return suspected(df, ids, identity, inside=False).unionByName(kept)


def stored(df: DataFrame, label: str) -> DataFrame:
    """A result written to the shared folder and read back: from here on nothing before it is computed again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, name: str, content: bytes) -> str:
    """Gives every executor a read-only copy of a small file; returns the name `local_copy` takes.

    What the driver needed to make the content is free by now and goes back to the system.
    """
    release()
    own = f"{name}-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), own)
    with open(path, "wb") as out:
        out.write(content)
    spark.sparkContext.addFile(path)
    tidy(spark)
    return own


def shipped_file(spark: SparkSession, path: str) -> str:
    """As `shipped`, for a file the driver already has."""
    with open(path, "rb") as file:
        return shipped(spark, os.path.basename(path), file.read())


#: Share of the greatest heap from which the driver's JVM is asked to collect.
HEAP_SHARE = 0.4


def tidy(spark: SparkSession) -> None:
    """A large heap of the driver's JVM is collected, which makes it smaller; shuffles and broadcasts that nothing refers to go with it.

    By itself the JVM lets the heap grow with every task that ends, up to the limit, and keeps that.
    """
    lang = spark.sparkContext._jvm.java.lang
    heap = lang.Runtime.getRuntime()
    if heap.totalMemory() >= HEAP_SHARE * heap.maxMemory():
        lang.System.gc()


def local_copy(name: str) -> str:
    return SparkFiles.get(name)


def release() -> None:
    """Gives freed memory back to the system: a worker, as the driver, would keep the peak of the stage before."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


_LOADED: dict[str, object] = {}


def once(key: str, make: Callable[[], object]) -> object:
    """One object per worker process: models outlive the tasks that use them. Only the two used last stay: no stage needs more."""
    found = _LOADED.pop(key, None)
    if found is None:
        while len(_LOADED) >= 2:
            _LOADED.pop(next(iter(_LOADED)))
        gc.collect()
        release()
        found = make()
    _LOADED[key] = found
    return found
