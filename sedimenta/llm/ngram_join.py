"""Jaccard join of documents on sets of word n-grams, exact at every size, with R-trees over count vectors.

A document's shingles are hashed into groups. If two sets of sizes a and b link, at most D = (a + b)(1 - t) / (1 + t)
shingles lie in one of them only. Spread over more than D groups, some group is the same in both: its content
is a key on which the documents meet, so no pair is lost and only near copies meet. Shingles that many documents share
are left out of the contents, which only lessens the differences; a document that has too few others meets its
like on all its shingles as well. Documents that meet, directly or through others, form a candidate cluster. Inside it the numbers of shingles per group are a point
of an R-tree; the overlap of two sets is at most the sum over groups of the smaller count, for a node of the tree the
smaller of the query's and the node's greatest count. Pairs that survive this bound are verified on the sets.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from sedimenta.llm.common import as_arrow, blocks, local_copy, once, shipped, stored, suspected, tidy, without
from sedimenta.llm.components import components
from sedimenta.session import scratch_path

#: Groups of a point of the R-tree, entries of its nodes.
POINT_GROUPS, FANOUT = 64, 16
#: Sizes of one class differ by this factor at most.
STEP = 1.5
#: Documents and shingles of a block of a candidate cluster; larger clusters are compared block by block.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 1 << 20
CACHE_WORDS = 250_000
#: A shingle is common when it is met so often among COUNTED shingles of a task; so many of the most common are shipped.
COMMON, COUNTED, COMMON_SHINGLES = 4, 1 << 21, 1 << 18
_NONE = np.zeros(0, np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of hashed word n-grams; remembers the hashes of words."""

    def __init__(self, words: int):
        self.n, self.known = words, {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct 64-bit hashes of each text's shingles; a text with fewer words is one shingle."""
        known, n, out = self.known, self.n, []
        for text in texts:
            # bytes: only A-Z become lower case, only blank and \t-\r separate
            words = text.encode().lower().split() if text else []
            if not words:
                out.append(np.zeros(0, np.uint64))
                continue
            found = [*map(known.get, words)]
            if None in found:
                if len(known) + len(words) > CACHE_WORDS:
                    known.clear()
                for w in set(words):
                    if w not in known:
                        known[w] = xxh3_64_intdigest(w)
                found = [known[w] for w in words]
            h = np.array(found, np.uint64)
            width = min(n, len(h))
            acc = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
            for k in range(width):
                acc = _mix(acc * _M1 + h[k : len(h) - width + 1 + k] + _M3)
            out.append(np.unique(acc))
        return out


class Rule:
    """Two sets link when den * intersection >= num * union."""

    def __init__(self, num: int = 90, den: int = 100):
        if not 2 * den < 3 * num <= 3 * den:
            raise ValueError("the threshold lies above 2/3 and is at most 1")
        self.num, self.den = num, den
        # the smallest size that can link to another set: two sets of that size and one more may differ
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * STEP)))

    def differing(self, total):
        """Most shingles that lie in one of two linked sets with `total` elements together."""
        return total * (self.den - self.num) // (self.den + self.num)

    def largest(self, size):
        return size * self.den // self.num

    def needed(self, total):
        """Least intersection of two linked sets."""
        return -(-total * self.num // (self.den + self.num))

    def groups(self, top: int) -> int:
        """Groups of a class with sets of up to `top`: more than can differ, and more than chance leaves empty."""
        least = self.differing(2 * top) + 1
        empty = least * np.exp(-top / least)
        return least + 2 + int(np.ceil(empty + 5 * np.sqrt(empty)))

    def keys(self, shingles: np.ndarray, common: np.ndarray = _NONE) -> np.ndarray:
        """The keys on which a set meets every other set that it links to, whatever `common` (sorted) holds."""
        size, out = len(shingles), []
        if not size or not self.differing(size + self.largest(size)):
            return np.zeros(0, np.int64)  # it links to itself only
        rare = shingles
        if len(common):
            at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
            rare = shingles[common[at] != shingles]
        own = int(np.searchsorted(self.bounds, size, "right"))
        for c in (own, own + 1) if self.largest(size) >= self.bounds[own] else (own,):
            top = self.bounds[c] - 1
            groups = self.groups(top)
            differing = self.differing(size + min(top, self.largest(size)))
            used, names, content = self._contents(rare, groups, c)
            out.append(_mix(content * _M1 + names))
            if len(used) <= differing:
                # the groups in use may all differ: such sets meet on all their shingles, among themselves
                used, names, content = self._contents(shingles, groups, c)
                out.append(_mix(content * _M3 + names))
            if len(used) <= differing:
                # and if that is not enough, on their empty groups too
                empty = np.setdiff1d(np.arange(groups), used).astype(np.uint64) + np.uint64(c << 40)
                out.append(_mix(_mix(empty * _M2 + _M1) + _M3))
        return np.concatenate(out).view(np.int64)

    @staticmethod
    def _contents(shingles: np.ndarray, groups: int, size_class: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The groups in use, their hashed names and the hashes of their contents."""
        if not len(shingles):
            return np.zeros(0, np.int64), _NONE, _NONE
        group = ((shingles >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        used, starts = np.unique(group[order], return_index=True)
        content = np.add.reduceat(_mix(shingles[order] * _M3), starts)
        return used, _mix((used.astype(np.uint64) + np.uint64(size_class << 40)) * _M2 + _M1), content


def _digest(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def common_shingles(docs: DataFrame, words: int, text: str) -> bytes:
    """The sorted hashes of shingles that many documents share, counted over all documents; a bounded number of them.

    Which shingles these are is a matter of speed only: links do not depend on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = once(f"shingles {words}", lambda: Shingler(words)), [], 0

        def counted() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate([*held, _NONE]), return_counts=True)
            held.clear()
            often = n >= COMMON
            return pa.record_batch([pa.array(value[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["shingle", "n"])

        for batch in batches:
            for block in blocks(batch, "text"):
                for s in shingler.sets(block.column("text").to_pylist()):
                    held.append(s)
                    size += len(s)
                if size >= COUNTED:
                    yield counted()
                    size = 0
        yield counted()

    counts = docs.select(F.col(text).alias("text")).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = stored(counts, "shingles")
    # from the highest power of two down, as many as fit
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["k"] for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("k")).collect()}
    least, total = 64, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > COMMON_SHINGLES:
            break
        least = p
    top = counts.filter(power >= least).select("shingle").toArrow().column("shingle")
    return np.sort(np.asarray(top).astype(np.int64).view(np.uint64)).tobytes()


#: Keys that a task holds before it packs them, keys that one reduce group gets, and keys of a document, about.
PACKED, PER_GROUP, KEYS_EACH = 1 << 20, 1 << 20, 200
#: Bits of a key that count: what differs in the others meets by mistake and is told apart on the sets.
KEY_BITS = 56
_SIGNATURE = "doc_id long, n_shingles long, node binary, mark long, other long, part int, packed binary"


class Meetings:
    """The keys of a task's sets. Packed, each key takes a few bytes, and only one set of the task goes on with a key it shares."""

    def __init__(self, task: int, parts: int):
        self.task, self.shift = task, np.uint64(KEY_BITS - (parts - 1).bit_length())
        self.keys: list[np.ndarray] = []
        self.marks: list[np.ndarray] = []
        self.held = 0

    def add(self, ordinal: int, keys: np.ndarray) -> None:
        self.keys.append(keys.view(np.uint64) >> np.uint64(64 - KEY_BITS))
        self.marks.append(np.full(len(keys), ordinal, np.uint32))
        self.held += len(keys)

    def pack(self) -> tuple[list[tuple[int, int]], list[tuple[int, bytes]]]:
        """Links between sets of this task that share a key, and for each part of the key range its sorted keys with one set each."""
        keys, marks = np.concatenate([_NONE, *self.keys]), np.concatenate([np.zeros(0, np.uint32), *self.marks])
        self.keys, self.marks, self.held = [], [], 0
        order = np.lexsort((marks, keys))
        keys, marks = keys[order], marks[order]
        first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
        least = marks[first][np.cumsum(first) - 1] if len(keys) else marks
        joined = np.unique(np.stack([marks, least])[:, marks != least], axis=1)
        base = self.task << 31
        links = [(base + int(a), base + int(b)) for a, b in joined.T]
        keys, marks = keys[first], marks[first]
        part = (keys >> self.shift).astype(np.int64)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        out = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            gaps = np.diff(keys[start:end], prepend=keys[start] & ~((np.uint64(1) << self.shift) - np.uint64(1)))
            out.append((int(part[start]), struct.pack("<QQI", base, int(part[start]), end - start) + _bytes(gaps) + _bytes(marks[start:end].astype(np.uint64))))
        return links, out

    @staticmethod
    def unpack(raw: bytes, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and marks of a packed part."""
        base, part, n = struct.unpack_from("<QQI", raw)
        gaps, at = _numbers(raw, struct.calcsize("<QQI"), n)
        marks, _ = _numbers(raw, at, n)
        return np.cumsum(gaps, dtype=np.uint64) + (np.uint64(part) << np.uint64(shift)), marks.astype(np.int64) + np.int64(base)


def _bytes(values: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs, after one byte that says how many."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _numbers(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width, end = raw[at], at + 1 + n * raw[at]
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(n, width)
    return wide.view("<u8").ravel(), end


def signatures(docs: DataFrame, words: int, rule: Rule, identity: str, text: str, parts: int) -> DataFrame:
    """Rows of three kinds: a document's `(doc_id, n_shingles, node, mark)`, a link `(mark, other)`, and keys `(part, packed)`.

    `node` is the digest of a set. The first copy of a set in a task that has an id gets a mark, under which its keys go on.
    """
    common = shipped(docs.sparkSession, "common", common_shingles(docs, words, text))
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("mark", pa.int64()), ("other", pa.int64()), ("part", pa.int32()), ("packed", pa.binary())])

    def rows(**columns: list) -> pa.RecordBatch:
        n = max(map(len, columns.values()))
        return pa.record_batch([as_arrow(columns.get(f.name, [None] * n), f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = once(f"shingles {words}", lambda: Shingler(words)), set()
        shared = once(f"common {common}", lambda: np.fromfile(local_copy(common), np.uint64))
        task = TaskContext.get().partitionId()
        meetings, ordinal = Meetings(task, parts), 0

        def packed() -> Iterator[pa.RecordBatch]:
            links, blobs = meetings.pack()
            if links:
                yield rows(mark=[a for a, _ in links], other=[b for _, b in links])
            if blobs:
                yield rows(part=[p for p, _ in blobs], packed=[b for _, b in blobs])

        for batch in batches:
            for block in blocks(batch, "text"):
                sets = shingler.sets(block.column("text").to_pylist())
                nodes = [_digest(s) if len(s) else None for s in sets]
                marks: list[int | None] = []
                for name, s, node in zip(block.column("id").to_pylist(), sets, nodes):
                    marks.append(None)
                    # a row without an id links nothing, so it is no first copy
                    if name is None or node is None or node in seen:
                        continue
                    if len(seen) < CACHE_WORDS:
                        seen.add(node)
                    keys = rule.keys(s, shared)
                    if len(keys):
                        marks[-1] = (task << 31) + ordinal
                        meetings.add(ordinal, keys)
                        ordinal += 1
                    if meetings.held >= PACKED:
                        yield from packed()
                yield rows(doc_id=block.column("id"), n_shingles=[len(s) for s in sets], node=nodes, mark=marks)
        yield from packed()

    given = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInArrow(run, _SIGNATURE)


def met(packed: DataFrame, parts: int) -> DataFrame:
    """`(a, b)` marks that share a key, from `(part, packed)`: each with the least mark of that key. Keys of one set only leave no row."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    shift = KEY_BITS - (parts - 1).bit_length()

    def run(table: pa.Table) -> pa.Table:
        held = [Meetings.unpack(raw.as_py(), shift) for raw in table.column("packed")]
        keys, marks = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((marks, keys))
        keys, marks = keys[order], marks[order]
        first = np.append(True, keys[1:] != keys[:-1])
        least = marks[first][np.cumsum(first) - 1]
        pairs = np.unique(np.stack([marks, least])[:, marks != least], axis=1)
        return pa.table([pa.array(pairs[0]), pa.array(pairs[1])], schema=schema)

    return packed.groupBy("part").applyInArrow(run, "a long, b long")


# -- inside a candidate cluster -------------------------------------------------------------


class CountTree:
    """A packed R-tree over group counts. Every node knows the greatest count of each group and the smallest size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        spread = np.argsort(-points.var(axis=0), kind="stable")[:2] if len(points) else []
        self.order = np.lexsort([points[:, g] for g in spread] + [sizes])
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        top, least, most = points[self.order], sizes[self.order], sizes[self.order]
        while len(top) > FANOUT or not self.levels:
            cuts = np.arange(0, len(top), FANOUT)
            top, least, most = np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((top, least, most))

    def near(self, point: np.ndarray, size: int, rule: Rule) -> np.ndarray:
        """All points whose overlap with the given one may reach what a link needs."""
        low, high = -(-size * rule.num // rule.den), rule.largest(size)
        nodes = np.arange(len(self.levels[-1][0]))
        for top, least, most in reversed(self.levels):
            nodes = nodes[nodes < len(top)]
            fits = (most[nodes] >= low) & (least[nodes] <= high)
            nodes = nodes[fits]
            bound = np.minimum(top[nodes], point).sum(axis=1)
            nodes = nodes[bound >= rule.needed(size + np.maximum(least[nodes], low))]
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        leaves = self.order[nodes[nodes < len(self.order)]]
        leaves = leaves[(self.sizes[leaves] >= low) & (self.sizes[leaves] <= high)]
        bound = np.minimum(self.points[leaves], point).sum(axis=1)
        return leaves[bound >= rule.needed(size + self.sizes[leaves])]


def links_within(sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links that connect whatever is connected among the sets; a pair already connected is not looked at again."""
    sizes = np.array([len(s) for s in sets], np.int64)
    points = np.zeros((len(sets), POINT_GROUPS), np.int32)
    for i, s in enumerate(sets):
        points[i] = np.bincount((s & np.uint64(POINT_GROUPS - 1)).astype(np.int64), minlength=POINT_GROUPS)
    tree = CountTree(points, sizes)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(int(codes.max(initial=0)) + 1, np.int32)
    label, out = np.arange(len(sets)), []
    for i in range(len(sets)):
        near = tree.near(points[i], int(sizes[i]), rule)
        near = np.sort(near[label[near] != label[i]])
        if not len(near):
            continue
        own = codes[starts[i] : ends[i]]
        mark[own] = 1
        n = sizes[near]
        cells = np.repeat(starts[near] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.add.reduceat(mark[codes[cells]], np.cumsum(n) - n)
        mark[own] = 0
        linked = near[rule.den * both >= rule.num * (n + sizes[i] - both)]
        for j in linked.tolist():
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                out.append((i, j))
    return out


def _verified(pairs: DataFrame, words: int, rule: Rule) -> DataFrame:
    """`(a, b)` digests of linked sets, from rows `(cluster, x, y, text)` grouped by cluster and pair of blocks."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        shingler = once(f"shingles {words}", lambda: Shingler(words))
        sets = {_digest(s): s for s in shingler.sets(table.column("text").to_pylist())}
        nodes = sorted(sets)
        found = links_within([sets[x] for x in nodes], rule)
        return pa.table([pa.array([nodes[i] for i, _ in found], pa.binary()), pa.array([nodes[j] for _, j in found], pa.binary())], schema=schema)

    return pairs.groupBy("cluster", "x", "y").applyInArrow(run, "a binary, b binary")


def join_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_shingles, component_id)`, one row per input row.

    Sets link when den * intersection >= num * union; `component_id` is the smallest doc_id reachable by
    links, the row's own included. A NULL text or one without words has 0 shingles and no link; a row without
    an id links nothing and has a NULL component. Rows of one id stand for one document with several texts.
    """
    spark, rule = docs.sparkSession, Rule(num, den)
    # parts of the key range, so that a group stays the same size however many documents there are
    parts, many = 256, docs.count()
    while parts * PER_GROUP < KEYS_EACH * many:
        parts *= 2
    path = scratch_path(spark, "signatures")
    signatures(docs, words, rule, identity, text, parts).write.parquet(path)
    tidy(spark)
    every = spark.read.schema(_SIGNATURE).parquet(path)
    own = every.filter(F.col("n_shingles").isNotNull()).select("doc_id", "n_shingles", "node", "mark")
    named = own.filter(F.col("doc_id").isNotNull() & F.col("node").isNotNull())

    near = every.filter(F.col("other").isNotNull()).select(F.col("mark").alias("a"), F.col("other").alias("b"))
    clusters = components(near.unionByName(met(every.filter(F.col("part").isNotNull()).select("part", "packed"), parts)))
    firsts = named.filter(F.col("mark").isNotNull()).select("doc_id", "n_shingles", "mark", F.col("node").alias("set"))
    # one document for each set of a cluster; a cluster of one set has nothing to verify
    members = firsts.join(clusters, F.col("mark") == F.col("node")).groupBy(F.col("label").alias("cluster"), "set")
    members = stored(members.agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles")), "members")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("shingles")).filter("docs > 1")
    number = F.ceil(F.greatest(F.col("docs") / BLOCK_DOCS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = stored(members.join(sizes.select("cluster", number.alias("blocks")), "cluster"), "members")
    mine = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    placed = members.select("doc_id", "cluster", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    placed = placed.select(F.col("doc_id").alias("_id"), "cluster", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"))
    texts = docs.select(F.col(identity).cast("long").alias("_id"), F.col(text).alias("text"))
    texts = suspected(texts, members.select(F.col("doc_id").alias("_id")), "_id")
    links = _verified(texts.join(placed, "_id").select("cluster", "x", "y", "text"), words, rule)

    # rows of one id are linked through it
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter(F.col("a") != F.col("b"))
    shared = named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    found = components(links.unionByName(shared))
    nodes = named.groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = labelled.select("node", "label").join(least, "label").select("node", "component_id")
    rows = own.select("doc_id", "n_shingles", "node").join(by_node, "node", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int, num: int, den: int, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, that are the first of their component; rows without an id stay."""
    parts = join_components(docs, words, num, den, identity, text)
    gone = parts.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(identity))
    return without(docs, stored(gone, "copies"), identity)
