"""Cosine top-K over a vector table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available in tasks
from pyarrow import dataset, fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sedimenta.session import scratch_path
from sedimenta.sources import fixed_values as fv

#: Queries of one matrix in a task.
QUERY_BLOCK = 2048
#: Products of whole blocks are exact to this; what is nearer to the k-th best is computed again, pair by pair.
MARGIN = 1e-9


def validate_vectors(vectors: DataFrame, size: int = fv.EMBEDDING_SIZE, vector: str = "embedding") -> DataFrame:
    """Adds `valido`: the vector has the declared size and a non-zero norm."""
    norm = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return vectors.withColumn("valido", F.coalesce((F.size(vector) == size) & (norm > 0), F.lit(False)))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = fv.TOP_K,
    vector_id: str = "vec_id",
    query_id: str = "query_id",
    vector: str = "embedding",
    min_score: float | None = None,
    digits: int = 6,
) -> DataFrame:
    """The `k` most similar vectors of every query: `(query_id, vec_id, score, rn)`.

    Exact, in one scan of the vectors for any number of queries. Vectors stay where they are: queries are written to
    the shared folder, and each task reads them block by block, scores its own Arrow batches against a
    block and keeps `k` rows per query and batch; only those are shuffled. Ranks and `min_score` go by the full
    score, equal scores by id; the score shown has `digits` decimals. NULL, zero and wrongly sized vectors
    have no cosine and are left out.
    """
    path = scratch_path(vectors.sparkSession, "queries")
    queries.select(query_id, vector).dropDuplicates([query_id]).write.parquet(path)
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(vector_id, vectors.schema[vector_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    partial = vectors.select(vector_id, vector).mapInArrow(_scorer(path, k, min_score, to_arrow_schema(schema)), schema)
    window = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(vector_id))
    ranked = partial.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") <= k)
    return ranked.withColumn("score", F.round("score", digits))


def _query_blocks(path: str) -> Iterator[tuple[pa.Array, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Ids and unit vectors of the written queries, by length of the vector."""
    store, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    for batch in dataset.dataset(place, filesystem=store, format="parquet").to_batches(batch_size=QUERY_BLOCK):
        yield batch.column(0), dict(_unit(batch.column(1)))


def _unit(lists: pa.Array) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """For each length: the rows that have it and a norm, and their unit vectors."""
    sizes = np.asarray(pa.compute.list_value_length(lists).fill_null(0))
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        norm = np.linalg.norm(flat, axis=1)
        good = norm > 0
        yield size, (rows[good], flat[good] / norm[good, None])


def _scorer(path: str, k: int, min_score: float | None, schema: pa.Schema):
    """Per batch and query: the k best by a matrix product with a margin, settled pair by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, ids = dict(_unit(batch.column(1))), batch.column(0)
            for names, asked in _query_blocks(path):
                found: list[tuple[np.ndarray, int, np.ndarray]] = []
                for size in mine.keys() & asked.keys():
                    (rows, block), (numbers, matrix) = mine[size], asked[size]
                    rough = block @ matrix.T
                    for column, number in enumerate(numbers.tolist()):
                        near = rough[:, column]
                        edge = np.partition(near, len(near) - k)[len(near) - k] if len(near) > k else -2.0
                        some = np.flatnonzero(near >= (edge if min_score is None else max(edge, min_score)) - MARGIN)
                        exact = np.einsum("ij,j->i", block[some], matrix[column])
                        if min_score is not None:
                            some, exact = some[exact >= min_score], exact[exact >= min_score]
                        if len(some) > k:
                            edge = np.partition(exact, len(exact) - k)[len(exact) - k]
                            some, exact = some[exact >= edge], exact[exact >= edge]
                        found.append((rows[some], number, exact))
                if found:
                    taken = pa.array(np.concatenate([f[0] for f in found]))
                    wanted = pa.array(np.repeat([f[1] for f in found], [len(f[0]) for f in found]))
                    columns = [names.take(wanted), ids.take(taken), pa.array(np.concatenate([f[2] for f in found]))]
                    yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run
