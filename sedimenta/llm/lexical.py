"""Ranked lexical search: a sharded inverted index with block maxima, read by Block-Max MaxScore.

Each task packs the documents it reads into shards: for every term its postings, in blocks of documents and
frequencies, each with the shortest document of every frequency it holds. From these pairs the greatest score of
a block follows exactly, once the statistics of the whole corpus are known, without unpacking it. A search
orders an item's lists by their greatest score. Lists are read in full, highest first, while a document
that is on none of them could still be among the best; the lists after these are not essential: they are read
only for documents already met, and the maxima of their blocks reject documents before a block is unpacked. A task
hands the k-th best score on from shard to shard; the shards' heaps are merged at the end.
"""

from __future__ import annotations

import io
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available in tasks
import pyarrow.parquet as pq
from pyarrow import dataset, fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sedimenta.llm.common import blocks, release
from sedimenta.session import scratch_path

#: Text bytes and documents after which a task closes its shard; a longer text is a shard of its own.
SHARD_BYTES, SHARD_DOCS = 5 << 20, 1 << 14
#: A row group ends with the shard that takes it over this size: neither the writer nor a reader holds more than it and that shard.
GROUP_BYTES = 1 << 20
#: Postings of a block.
BLOCK = 128
#: Items that a task ranks at a time.
ITEMS = 1024
#: ASCII characters that are no part of a term, and A-Z, whose case goes.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.translate(_FOLD).split()


def terms_column(text: Column) -> Column:
    """As `terms_of`, as a column of texts; for short texts."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, _SEPARATOR, -1), lambda t: t != "")


# -- a shard --------------------------------------------------------------------------------


def _narrow(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of numbers in 1, 2 or 4 bytes each, as their greatest needs: the bytes, each block's offset and width."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.uint8)
    top = np.maximum.reduceat(values, starts)
    width = np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4)).astype(np.int64)
    sizes = np.diff(np.append(starts, len(values)))
    offsets = np.append(0, np.cumsum(sizes * width))
    out = np.zeros(int(offsets[-1]), np.uint8)
    block = np.repeat(np.arange(len(starts)), sizes)
    at = offsets[block] + (np.arange(len(values)) - starts[block]) * width[block]
    for byte in range(4):
        wide = width[block] > byte
        out[at[wide] + byte] = (values[wide] >> (8 * byte)) & 255
    return out, offsets, width.astype(np.uint8)


def pack(ids: list[int | None], words: list[np.ndarray], vocabulary: list[bytes]) -> dict:
    """A shard as a row. `words` has each document's term numbers, repeats included."""
    named = np.array([i is not None for i in ids], bool)
    order = np.lexsort((np.array([i or 0 for i in ids], np.int64), ~named))  # by id, those without one last
    length = np.array([len(w) for w in words], np.int64)[order]
    # the arrays below have a number for each word or posting: each goes when it is no longer needed
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rank = np.empty(len(vocabulary), np.int64)
    by_bytes = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
    rank[by_bytes] = np.arange(len(vocabulary))
    pairs = rank[np.concatenate([*words, np.zeros(0, np.int32)])]
    pairs *= len(ids)
    pairs += np.repeat(place, [len(w) for w in words])
    pairs.sort()
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    tf = np.diff(np.append(first, len(pairs)))
    pairs = pairs[first]
    del first
    term, doc = np.divmod(pairs, max(1, len(ids)))
    del pairs
    # blocks begin with every term and every BLOCK postings of it
    df = np.bincount(term, minlength=len(vocabulary))
    start_of = np.cumsum(df) - df
    starts = np.flatnonzero((np.arange(len(term)) - start_of[term]) % BLOCK == 0)
    size = np.diff(np.append(starts, len(term)))
    del term
    block = np.repeat(np.arange(len(starts)), size)
    gap = np.diff(doc, prepend=0)
    gap[starts] = 0
    docs, docs_at, docs_width = _narrow(gap, starts)
    tfs, tfs_at, tfs_width = _narrow(tf - 1, starts)
    del gap
    # of each frequency in a block, the shortest document
    by_tf = np.lexsort((length[doc], tf, block))
    new = np.flatnonzero(np.append(True, (np.diff(block[by_tf]) != 0) | (np.diff(tf[by_tf]) != 0))) if len(doc) else np.zeros(0, np.int64)
    best = by_tf[new]
    del by_tf, new
    out = io.BytesIO()
    np.savez(
        out,
        ids=np.array([ids[i] or 0 for i in order], np.int64),
        named=named[order],
        length=length,
        blocks=np.append(0, np.cumsum(-(-df // BLOCK))).astype(np.int64),
        first=doc[starts].astype(np.uint32),
        size=size.astype(np.uint8),
        docs=docs,
        docs_at=docs_at.astype(np.uint32 if docs_at[-1] < 1 << 32 else np.int64),
        docs_width=docs_width,
        tfs=tfs,
        tfs_at=tfs_at.astype(np.uint32 if tfs_at[-1] < 1 << 32 else np.int64),
        tfs_width=tfs_width,
        pair_at=np.append(np.searchsorted(block[best], np.arange(len(starts))), len(best)).astype(np.uint32),
        pair_tf=tf[best].astype(np.uint32),
        pair_length=length[doc[best]].astype(np.uint32),
    )
    return {
        "documents": int((length > 0).sum()),
        "words": int(length.sum()),
        "terms": [vocabulary[i] for i in by_bytes],
        "df": df.astype(np.int64),
        "shard": out.getvalue(),
    }


_SHARD = pa.schema([("documents", pa.int64()), ("words", pa.int64()), ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int64())), ("shard", pa.binary())])
_SHARD_ROW = "documents long, words long, terms array<binary>, df array<long>, shard binary"


def write_index(docs: DataFrame, folder: str, identity: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the index of all documents, one row per shard, and reads it back. Nothing is shuffled.

    NULL texts and texts without a term have no postings. Rows of one id are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        ids: list[int | None] = []
        words: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            row = pack(ids, words, [*numbers])
            numbers.clear(), ids.clear(), words.clear()
            numbers.default_factory = count().__next__
            release()
            return pa.record_batch([pa.array([row[f.name]], f.type) for f in _SHARD], schema=_SHARD)

        for batch in batches:
            for block in blocks(batch, "text"):
                for name, raw in zip(block.column("id").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                    found = terms_of(raw) if raw else []
                    if not found:
                        continue
                    if ids and (size + len(raw) > shard_bytes or len(ids) >= shard_docs):
                        yield closed()
                        size = 0
                    size += len(raw)
                    ids.append(name)
                    words.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        if ids:
            yield closed()

    shards = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, _SHARD_ROW)
    # without the first option the writer looks at sizes after 100 rows only, and a task's shards would all wait in memory
    shards.write.option("parquet.page.size.row.check.min", 1).option("parquet.block.size", GROUP_BYTES).parquet(folder)
    return docs.sparkSession.read.schema(_SHARD_ROW).parquet(folder)


def impact(tf: np.ndarray, length: np.ndarray, documents: int, words: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 12 * m) with m = 100 - 25 + (25 * length * documents) div words, in integers."""
    if len(length) and int(length.max()) * documents >= (1 << 62) // 25:
        part = np.array([25 * int(n) * documents // words for n in length], np.int64)
    else:
        part = 25 * length * documents // words
    return 1_000_000_000 * tf // (1000 * tf + 12 * (75 + part))


class Shard:
    """Reads a shard; lists are unpacked block by block, and counted in `unpacked`."""

    def __init__(self, terms: pa.Array, raw: bytes, documents: int, words: int):
        self.terms, self.stats = terms, (documents, words)
        with np.load(io.BytesIO(raw)) as held:
            self.__dict__.update({name: held[name] for name in held.files})
        self.unpacked = 0
        tf, length = self.pair_tf.astype(np.int64), self.pair_length.astype(np.int64)
        self.most = np.maximum.reduceat(impact(tf, length, documents, words), self.pair_at[:-1].astype(np.int64)) if len(tf) else np.zeros(0, np.int64)

    def numbers(self, wanted: pa.Array) -> np.ndarray:
        """The place of each term in the shard, -1 if it has none."""
        return np.asarray(pa.compute.fill_null(pa.compute.index_in(wanted, value_set=self.terms), -1)).astype(np.int64)

    def _values(self, raw: np.ndarray, at: np.ndarray, width: np.ndarray, some: np.ndarray) -> np.ndarray:
        size = self.size[some].astype(np.int64)
        w = np.repeat(width[some].astype(np.int64), size)
        start = np.repeat(at[some].astype(np.int64), size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)) * w
        out = raw[start].astype(np.int64)
        for byte in (1, 2, 3):
            wide = np.flatnonzero(w > byte)
            if not len(wide):
                break
            out[wide] |= raw[start[wide] + byte].astype(np.int64) << (8 * byte)
        return out

    def open(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents and impacts of blocks, in order."""
        self.unpacked += len(some)
        size = self.size[some].astype(np.int64)
        gaps = self._values(self.docs, self.docs_at, self.docs_width, some)
        begin = np.cumsum(size) - size
        run = np.cumsum(gaps)
        doc = run - np.repeat(run[begin] - self.first[some], size)
        tf = self._values(self.tfs, self.tfs_at, self.tfs_width, some) + 1
        return doc, impact(tf, self.length[doc], *self.stats)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (by place) and scores of the k best that score at least `floor`, ties to the smaller id."""
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        score = np.zeros(len(self.ids), np.int64)
        lists = [np.arange(self.blocks[t], self.blocks[t + 1]) for t in terms]
        bound = np.array([w * int(self.most[b].max()) for w, b in zip(weights, lists)], np.int64)
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # what the lists from here on can add
        least, at = max(floor, 1), 0
        # essential lists: a document on none of them could still reach the threshold
        while at < len(order) and rest[at] >= least:
            some = order[at]
            doc, value = self.open(lists[some])
            score[doc] += weights[some] * value
            at += 1
            if rest[at] >= least:
                least = max(least, self._kth(score, k))
        met = np.flatnonzero((score + rest[at] >= least) & (score > 0) & self.named)
        # the others: only for documents met, and only blocks that may lift one of them over the threshold
        for i in range(at, len(order)):
            if not len(met):
                break
            least = max(least, self._kth(score[met], k))
            some, own = order[i], lists[order[i]]
            block = np.searchsorted(self.first[own], met, "right") - 1
            most = np.where(block >= 0, weights[some] * self.most[own[np.maximum(block, 0)]], 0)
            fits = score[met] + most + rest[i + 1] >= least
            met, block, most = met[fits], block[fits], most[fits]
            needed = np.unique(block[block >= 0])
            if len(needed):
                doc, value = self.open(own[needed])
                place = np.minimum(np.searchsorted(doc, met), len(doc) - 1)
                hit = doc[place] == met
                score[met[hit]] += weights[some] * value[place[hit]]
        met = met[score[met] >= max(floor, 1)]
        if len(met) > 4 * k:
            met = met[score[met] >= self._kth(score[met], k)]
        best = np.lexsort((self.ids[met], -score[met]))[:k]
        return met[best], score[met[best]]

    def _kth(self, score: np.ndarray, k: int) -> int:
        if len(score) == len(self.ids) and not self.named.all():
            score = score[self.named]
        return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0


# -- search ---------------------------------------------------------------------------------


def weights(index: DataFrame, items: DataFrame, item: str, text: str) -> tuple[DataFrame, int, int]:
    """`(item_id, term, weight)` of the items' terms that the corpus holds, and the numbers N and L.

    Equal rows of an item count once; different texts of one id are one item with the terms of all. The weight has the
    term's repeats in the item.
    """
    documents, words = index.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    rows = items.select(F.col(item).alias("item_id"), F.col(text).alias("text")).filter("item_id IS NOT NULL").distinct()
    terms = rows.select("item_id", F.explode(terms_column(F.col("text"))).alias("word"))
    terms = terms.groupBy("item_id", F.col("word").cast("binary").alias("term")).agg(F.count(F.lit(1)).alias("repeats"))
    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    asked = terms.select("term").distinct()
    df = held.join(asked, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    return terms.join(df, "term").select("item_id", "term", (weight * F.col("repeats")).alias("weight")).filter("weight > 0"), documents, words


def _shared(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _shards(folder: str, wanted: pa.RecordBatch) -> Iterator[tuple[pa.Array, bytes]]:
    """Terms and bytes of the shards that `(file, row)` name, one after the other."""
    last, parquet, begin = None, None, 0
    try:
        for name, row in zip(wanted.column("file").to_pylist(), wanted.column("row").to_pylist()):
            if name != last or row < begin:
                if parquet:
                    parquet.close(force=True)
                store, place = _shared(f"{folder}/{name}")
                parquet, last, group, begin = pq.ParquetFile(store.open_input_file(place), pre_buffer=False), name, 0, 0
                held = None
            while row >= begin + parquet.metadata.row_group(group).num_rows:
                begin += parquet.metadata.row_group(group).num_rows
                group, held = group + 1, None
            if held is None:
                held = parquet.read_row_group(group, columns=["terms", "shard"], use_threads=False)
            yield held.column("terms")[row - begin].values, held.column("shard")[row - begin].as_py()
    finally:
        if parquet:
            parquet.close(force=True)


def _item_blocks(path: str) -> Iterator[list[tuple]]:
    store, place = _shared(path)
    for batch in dataset.dataset(place, filesystem=store, format="parquet").to_batches(batch_size=ITEMS):
        if not batch.num_rows:
            continue
        yield [(i, pa.array(t, pa.binary()), np.array(w, np.int64)) for i, t, w in zip(*(batch.column(c).to_pylist() for c in ("item_id", "terms", "weights")))]


def rank(docs: DataFrame, items: DataFrame, k: int = 20, identity: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", **shards: int) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: the k documents of the highest score above 0 for each item, all if fewer.

    Equal scores go by ascending doc_id. A document without an id counts in the corpus's statistics and is not ranked; rows of one
    id are ranked each by itself. Items without an id, and NULL or empty texts, give no rows. Ids of documents must be
    integers, or texts of integers. Other columns are ignored, whatever their names. Empty tables give no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lexical")
    index = write_index(docs, f"{path}/index", identity, text, **shards)
    asked, documents, words = weights(index, items, item, item_text)
    kind = items.schema[item].dataType.simpleString()
    # the heaviest first, so that no order of terms is left to chance
    lists = asked.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "term"))).alias("l"))
    lists = lists.select("item_id", F.expr("transform(l, x -> x.term)").alias("terms"), F.expr("transform(l, x -> -x.w)").alias("weights"))
    lists.write.parquet(f"{path}/items")
    none = np.zeros(0, np.int64)
    found = pa.schema([("item_id", to_arrow_type(items.schema[item].dataType)), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked in _item_blocks(f"{path}/items"):
                heaps: dict = {}
                whole = pa.concat_arrays([t for _, t, _ in asked])
                for terms, raw in _shards(f"{path}/index", batch):
                    shard = Shard(terms, raw, documents, words)
                    numbers = np.split(shard.numbers(whole), np.cumsum([len(t) for _, t, _ in asked])[:-1])
                    for (name, _, weight), own in zip(asked, numbers):
                        ids, scores = heaps.get(name, (none, none))
                        places, new = shard.top(own[own >= 0], weight[own >= 0], k, int(scores[-1]) if len(scores) == k else 1)
                        ids, scores = np.concatenate([ids, shard.ids[places]]), np.concatenate([scores, new])
                        best = np.lexsort((ids, -scores))[:k]
                        heaps[name] = ids[best], scores[best]
                names = [n for n, (ids, _) in heaps.items() for _ in range(len(ids))]
                columns = [np.concatenate([none, *[h[j] for h in heaps.values()]]) for j in (0, 1)]
                yield pa.record_batch([pa.array(names, found[0].type), *[pa.array(c) for c in columns]], schema=found)

    # a task gets the places of its shards and reads one at a time: rows of such size would pass through the JVM many together
    places = index.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    best = places.mapInArrow(search, f"item_id {kind}, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(item), "rank", F.col("doc_id").alias(identity), "score")
