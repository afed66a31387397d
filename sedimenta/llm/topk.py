"""Exact top-k by inner product over an impact-ordered index, read score-at-a-time.

A block of vectors is stored as segments of postings: one for each dimension and quantised value, with the rows that
have it. A group of queries reads segments by descending impact, the sum of its |q_d * value|, and each adds to its accumulators. At
checkpoints the unread segments bound what every row can still gain or lose; rows whose upper bound reaches the k-th best lower bound
may be members. Reading stops when that proof has left few rows, and those are scored exactly.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import scratch_path

#: Rows of an index block and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 14, 512
#: Quantised values of a dimension: narrower vectors are held exactly, wider ones in steps of a power of two.
LEVELS = 128
#: Queries that read the postings of a block together.
GROUP = 128
#: Shares of a group's impact after which the proof is tried.
CHECKPOINTS = (0.35, 0.55, 0.75, 0.9)


class Segments:
    """The postings of a block: for each dimension, rows by quantised value."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        span = int(matrix.max(initial=0)) - int(matrix.min(initial=0))
        self.step = 1 << (span // LEVELS).bit_length()
        levels = matrix // self.step
        rows, dims, values, starts = [], [], [], [0]
        for d in range(matrix.shape[1]):
            order = np.argsort(levels[:, d], kind="stable").astype(np.int32)
            value, first = np.unique(levels[order, d], return_index=True)
            rows.append(order)
            dims += [d] * len(value)
            values.append(value)
            starts += (starts[-1] + np.append(first[1:], len(order))).tolist()
        self.rows = np.concatenate([*rows, np.zeros(0, np.int32)])
        self.dims = np.array(dims, np.int64)
        self.values = np.concatenate([*values, np.zeros(0, np.int64)]) * self.step
        self.starts = starts
        self.by_id = np.argsort(ids, kind="stable")

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the k best rows that do not have the query's id; ties to the smaller id."""
        return next(self.tops(np.array([query_id]), query[None], k))

    def tops(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """`top` of each query. A group of queries reads the postings together."""
        width = min(queries.shape[1], self.matrix.shape[1])
        asked = np.zeros((len(queries), self.matrix.shape[1]), np.int64)
        asked[:, :width] = queries[:, :width]  # a vector's missing components are 0
        ordered = self.ids[self.by_id]
        first, end = (np.searchsorted(ordered, query_ids, side).tolist() for side in ("left", "right"))
        own = [self.by_id[a:b] for a, b in zip(first, end)]
        for at in range(0, len(asked), GROUP):
            q = asked[at : at + GROUP]
            for vector, possible in zip(q, self._possible_of(q, own[at : at + GROUP], k)):
                scores, ids = self.matrix[possible] @ vector, self.ids[possible]
                best = np.lexsort((ids, -scores))[:k]
                yield ids[best], scores[best]

    def _possible(self, q: np.ndarray, mine: np.ndarray, k: int) -> np.ndarray:
        return self._possible_of(q[None], [np.setdiff1d(np.arange(len(self.ids)), mine)], k)[0]

    def _possible_of(self, queries: np.ndarray, own: list[np.ndarray], k: int) -> list[np.ndarray]:
        """For each query the rows that may be among its k best, without its `own` rows."""
        size, n = len(self.ids), len(queries)
        candidates = np.ones((n, size), bool)
        for mask, rows in zip(candidates, own):
            mask[rows] = False
        if not len(self.dims) or size <= k + max(map(len, own)):
            return [np.flatnonzero(mask) for mask in candidates]
        rows, starts, weight = self.rows, self.starts, queries.T[self.dims]
        base = weight * self.values[:, None]  # what is added for a posting: its value rounded down
        other = weight * (self.values + self.step - 1)[:, None]
        low, high = np.minimum(base, other), np.maximum(base, other)
        # the impact of a segment on the group; in floats, as a sum over queries may pass 64 bits
        impact = np.abs(weight.astype(float) * (self.values + self.step // 2)[:, None]).sum(axis=1)
        order = np.argsort(-impact, kind="stable")
        mass = np.cumsum(impact[order])
        stops = sorted({*np.searchsorted(mass, np.array(CHECKPOINTS) * mass[-1]).tolist(), len(order)})
        # a posting that is read leaves its rounding open
        over, under = np.maximum(queries.T, 0) * (self.step - 1), np.minimum(queries.T, 0) * (self.step - 1)
        most = self.matrix.shape[1] * int(np.abs(queries).max()) * (int(np.abs(self.values).max()) + self.step)
        kind = np.int32 if most < 1 << 31 else np.int64
        score, added = np.zeros((size, n), kind), base.astype(kind)
        at = 0
        for stop in stops:
            for s in order[at:stop].tolist():
                score[rows[starts[s] : starts[s + 1]]] += added[s]
            at = stop
            gain, loss = over.copy(), under.copy()
            unread = np.sort(order[at:])  # segments are numbered by dimension
            if len(unread):
                dims, first = np.unique(self.dims[unread], return_index=True)
                gain[dims] = np.maximum(gain[dims], np.maximum.reduceat(high[unread], first))
                loss[dims] = np.minimum(loss[dims], np.minimum.reduceat(low[unread], first))
            open_ = gain.sum(axis=0) - loss.sum(axis=0)
            if stop < len(order) and (score.max(axis=0).astype(np.int64) - score.min(axis=0) <= open_).any():
                continue  # nothing can be excluded for some query yet
            left = []
            for known, mask, width in zip(np.ascontiguousarray(score.T).astype(np.int64), candidates, open_.tolist()):
                mine = np.flatnonzero(mask)
                known = known[mine]
                left.append(mine[known + width >= np.partition(known, len(known) - k)[len(known) - k]])
            if max(map(len, left)) <= max(8 * k, size // 8):
                break
        return left


def integers(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component; NULL for vectors that are NULL or hold NULL or non-finite components.

    Components of 2 ** 31 and more end the query with an error that says so.
    """
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))), F.lit(False)))
    # a guard inside, too: the branches of a condition may be computed before it
    def component(x: Column) -> Column:
        value = x.cast("double") * scale
        far = F.raise_error(F.lit(f"a vector component times {scale} reaches 2 ** 31: scores would not fit 64-bit integers"))
        small = F.when(F.abs(value) < float(1 << 31), F.floor(value))
        return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), F.coalesce(small, far))

    whole = F.transform(vector, component)
    return F.when(F.col(vector).isNotNull() & fine, whole)


def _packed(ids: list[int], vectors: list[list[int]]) -> bytes:
    width = max(map(len, vectors), default=0)
    matrix = np.zeros((len(ids), width), np.int64)
    for row, v in zip(matrix, vectors):
        row[: len(v)] = v
    if width * int(np.abs(matrix).max(initial=0)) ** 2 >= 1 << 63:
        raise ValueError("vectors are too large for exact 64-bit scores")
    out = io.BytesIO()
    np.savez(out, ids=np.array(ids, np.int64), matrix=matrix.astype(np.min_scalar_type(-int(np.abs(matrix).max(initial=1)) - 1)))
    return out.getvalue()


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    with np.load(io.BytesIO(raw)) as held:
        return held["ids"], held["matrix"].astype(np.int64)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """`(number, block)`: rows packed as they come from each task; nothing is shuffled, so no key can be hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        held: list[list[int]] = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            held += batch.column(1).to_pylist()
            while len(ids) >= rows:
                yield pa.record_batch([pa.array([part << 32 | seq]), pa.array([_packed(ids[:rows], held[:rows])], pa.binary())], names=["number", "block"])
                del ids[:rows], held[:rows]
                seq += 1
        if ids:
            yield pa.record_batch([pa.array([part << 32 | seq]), pa.array([_packed(ids, held)], pa.binary())], names=["number", "block"])

    return vectors.mapInArrow(run, "number long, block binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, identity: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each query the k rows of the highest inner product, all if fewer.

    Rows with the query's id are not its candidates. Queries of one id count once, by their smallest vector. Rows
    without an id or with an unusable vector take no part; shorter vectors are filled with zeros. Scores
    are 64-bit integers.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(identity).cast("long").alias("id"), integers(vector, scale).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")

    path = scratch_path(spark, "impacts")
    asked = usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    _blocks(usable(vectors), BLOCK_ROWS).write.parquet(f"{path}/index")
    _blocks(asked, BLOCK_QUERIES).write.parquet(f"{path}/queries")
    index, blocks = (spark.read.schema("number long, block binary").parquet(f"{path}/{x}") for x in ("index", "queries"))
    # each block of queries meets each block of the index, once; only the numbers of blocks are listed here
    rows = [r["number"] for r in index.select("number").collect()]
    columns = [r["number"] for r in blocks.select("number").collect()]
    if not rows or not columns:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    left = index.select(F.col("number").alias("i"), F.col("block").alias("rows"), F.explode(F.lit(columns).cast("array<long>")).alias("q"))
    right = blocks.select(F.col("number").alias("q"), F.col("block").alias("asked"), F.explode(F.lit(rows).cast("array<long>")).alias("i"))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, asked in zip(batch.column("rows"), batch.column("asked")):
                segments = Segments(*_unpacked(packed.as_py()))
                names, vectors = _unpacked(asked.as_py())
                found = [(q, *best) for q, best in zip(names, segments.tops(names, vectors, k))]
                columns = [np.repeat([f[0] for f in found], [len(f[1]) for f in found])]
                columns += [np.concatenate([f[j] for f in found]) for j in (1, 2)]
                yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], schema=out)

    # more partitions than AQE would choose by size: a pair of blocks is few bytes and much work
    tasks = min(len(rows) * len(columns), 10_000)
    best = left.join(right, ["i", "q"]).select("rows", "asked").repartition(tasks).mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
