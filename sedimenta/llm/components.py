"""Connected components of links: tasks contract their own links, then parents are compared and replaced by theirs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import release, stored

#: Far above the rounds that any graph needs: their number grows with the logarithm of its size, squared.
MOST_ROUNDS = 200
#: Links that a task contracts at a time.
BLOCK_LINKS = 1 << 18


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of nodes 0 to n - 1."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != (above := label[label])).any():
            label = above


def _contracted(links: DataFrame) -> DataFrame:
    """The same components by links from a node to the least of its part of the component, at most one of a node in each block."""

    def forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (pa.chunked_array([x.column(k) for x in held]).combine_chunks() for k in (0, 1))
        coded = pa.concat_arrays([a, b]).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[np.asarray(order)] = np.arange(len(order))
        code = rank[np.asarray(coded.indices)]
        label = least_labels(code[: len(a)], code[len(a) :], len(order))
        nodes = coded.dictionary.take(order)
        lower = np.flatnonzero(label != np.arange(len(order)))
        return pa.record_batch([nodes.take(pa.array(lower)), nodes.take(pa.array(label[lower]))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= BLOCK_LINKS:
                yield forest(held)
                held = []
        if held:
            yield forest(held)
        release()

    return links.select("a", "b").mapInArrow(run, links.select("a", "b").schema)


def _one_parent(links: DataFrame) -> DataFrame:
    """`(a, b, more)`: each node with its least parent, and with `more` links from its other parents to that one.

    A block names a parent of a node once at most, so even a node of many links has few rows here.
    """
    parents = _contracted(links).groupBy("a").agg(F.sort_array(F.collect_set("b")).alias("all"))
    every = parents.select("a", F.col("all")[0].alias("least"), F.posexplode("all").alias("k", "b"))
    return every.select(F.when(F.col("k") == 0, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"), (F.col("k") > 0).alias("more"))


def _next_parent(links: DataFrame) -> DataFrame:
    """`(a, b, moved)`: links to a node that has a parent lead to that parent. The join can split a node with many links."""
    above = links.filter(~F.col("more")).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    joined = links.join(above, F.col("b") == F.col("_a"), "left")
    return joined.select("a", F.coalesce("_b", "b").alias("b"), (F.col("more") | F.col("_b").isNotNull()).alias("moved"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`(node, label)` of every node that has a link to another: the label is the smallest node of its component.

    Links lead from the larger node to the smaller. Each half of a round is written to the shared folder, which cuts
    the lineage, so that no shuffle is computed twice; when no link was moved, every node is linked to its label.
    Nothing but the number of moved links reaches the driver. NULL ends and self-links are ignored.
    """
    known = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    # stored first: links made by Python would need a second worker for each task, and all workers keep what they load
    now = stored(known.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")), "links")
    for _ in range(MOST_ROUNDS):
        now = stored(_next_parent(stored(_one_parent(now), "parents")), "stars")
        if not now.agg(F.count_if("moved").alias("n")).first()["n"]:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
