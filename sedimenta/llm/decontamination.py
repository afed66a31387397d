"""Benchmark decontamination by latent semantic retrieval: a distributed randomised SVD of TF-IDF passages finds
candidates by cosine, then the longest common subsequence of words and the end of the item decide. Beside them all
texts that may hold an item word by word, or a short item nearly so, are candidates: shared terms bound what is common,
so none is missed.

Columns of the matrix are the benchmark's terms, rows its items and all corpus passages that share several content
terms with it. With M = A'A and a random test matrix W one pass gives Z = MW, and M is close to
Z (W'Z)^-1 Z' (Nystrom), whose eigenvectors are the right singular vectors of A. Only Z, of terms x rank, leaves the tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import as_arrow, blocks, local_copy, once, shipped, stored, suspected, without
from sedimenta.session import scratch_path

#: Passages are windows of so many words, one beginning every STRIDE words.
WINDOW, STRIDE = 64, 16
#: Half of it, and RANK - SURPLUS, are the most items that are looked for in one pass. More items take more passes, as
#: do more words than these: they bound the terms, and with them the matrices of terms x rank. A longer item is alone.
ITEMS_A_PASS, WORDS_A_PASS = 4096, 1 << 15
#: A term found in more of the passages (and more often than so) is no content term, unless it is among the rarest
#: of an item.
CONTENT_SHARE, CONTENT_LEAST, RAREST = 0.0005, 64, 8
#: Content terms that a passage needs to be a row of the matrix.
SHARED = 4
#: Most right singular vectors, and how many more than items; the weight of the items' own rows, so that few leaks
#: are not lost among noise.
RANK, SURPLUS, ITEM_WEIGHT = 640, 64, 3.0
COSINE = 0.6
#: A passage is a leak when so much of the item is a common subsequence, or so much and the item's end too.
SURE, LIKELY, END_WORDS, END_SHARE = 0.8, 0.55, 8, 0.6
#: Items of up to so many words are looked for in windows of their own as well, one beginning every STRIDE words: a
#: span of such an item and a sixth more lies in one of them. Longer items: so many of the rarest terms are compared.
SHORT, SHORT_WINDOW, COMPARED = 15, 32, 16
#: How a candidate was found: by cosine, in a short window, by all of its terms in one text.
LATENT, NEAR, VERBATIM = range(3)
CACHE_CHUNKS = 250_000
_SIGNS = re.compile(r"[\W_]+")


def word(chunk: str) -> str:
    return chunk.lower() if chunk.isalnum() else _SIGNS.sub("", chunk.lower())


class Vocabulary:
    """The benchmark's words that are not in many of its items, numbered. Items with few such words keep their rarest."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, [w for w in map(word, t.split()) if w]) for i, t in items]
        self.items = [(i, w) for i, w in self.items if w]
        in_items: dict[str, int] = {}
        for _, words in self.items:
            for w in set(words):
                in_items[w] = in_items.get(w, 0) + 1
        most = max(2, 0.05 * len(self.items))
        kept: set[str] = set()
        for _, words in self.items:
            rare = sorted(set(words), key=lambda w: (in_items[w], w))
            kept.update(rare[:RAREST])
            kept.update(w for w in rare if in_items[w] <= most)
        self.terms = {w: k for k, w in enumerate(sorted(kept))}


def least_common(words: int) -> int:
    """Words in common with a short item that its copy needs at least; an item that is all end has to be sure."""
    return next(k for k in range(1, words + 1) if k / words >= (SURE if words <= END_WORDS else LIKELY))


class SharedTerms:
    """Finds texts or windows that share as many terms with an item as a copy of it has; none of these is missed.

    Of a short item a copy may lack some words, of a longer one none. Terms whose number exceeds what may be lacking
    cannot all be absent, so the rarest of these lead to the item.
    """

    def __init__(self, items: list[tuple[int, list[str]]], terms: dict[str, int], frequency: np.ndarray):
        posts: list[tuple[int, int]] = []
        self.terms, self.short = len(terms), np.array([len(w) <= SHORT for _, w in items])
        codes, times, ends, need = [], [], [], []
        for k, (_, words) in enumerate(items):
            own: dict[int, int] = {}
            for w in words:
                if w in terms:
                    own[terms[w]] = own.get(terms[w], 0) + 1
            lacking = len(words) - least_common(len(words)) if self.short[k] else 0
            rarest = sorted(own, key=lambda c: (frequency[c], c))
            for c in rarest:
                posts.append((c, k))
                lacking -= own[c]
                if lacking < 0:
                    break
            rarest = rarest if self.short[k] else rarest[:COMPARED]
            codes += rarest
            times += [own[c] for c in rarest]
            ends.append(len(codes))
            # words that are no terms may all be there
            need.append(least_common(len(words)) - len(words) + sum(own.values()) if self.short[k] else sum(own[c] for c in rarest))
        posts.sort()
        self.posts = np.array([k for _, k in posts], np.int64)
        self.post_starts = np.searchsorted(np.array([c for c, _ in posts], np.int64), np.arange(self.terms + 1))
        self.codes, self.times, self.need = (np.array(x, np.int64) for x in (codes, times, need))
        self.starts = np.append(0, ends)

    def pairs(self, group: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`(group, item)` for rows of a group's number and a term in it."""
        key = np.unique(group.astype(np.int64) * self.terms + code)
        owner, term = key // self.terms, key % self.terms
        n = self.post_starts[term + 1] - self.post_starts[term]
        pair = np.repeat(owner, n) * len(self.need) + self.posts[_cells(self.post_starts[term], n)]
        pair = np.unique(pair)
        good = np.zeros(len(pair), bool)
        for a in range(0, len(pair), 1 << 16):
            owner, item = np.divmod(pair[a : a + (1 << 16)], len(self.need))
            n = self.starts[item + 1] - self.starts[item]
            which, cells = np.repeat(np.arange(len(item)), n), _cells(self.starts[item], n)
            wanted = owner[which] * self.terms + self.codes[cells]
            there = key[np.minimum(np.searchsorted(key, wanted), len(key) - 1)] == wanted
            good[a : a + len(item)] = np.bincount(which, there * self.times[cells], minlength=len(item)) >= self.need[item]
        return np.divmod(pair[good], len(self.need))


def _cells(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each start on, n of them."""
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def least_sightings(vocabulary: Vocabulary) -> int:
    """Places of terms that a text has at least if it holds an item, or enough for a passage."""
    least = SHARED
    for _, words in vocabulary.items:
        lacking = len(words) - least_common(len(words)) if len(words) <= SHORT else 0
        least = min(least, sum(w in vocabulary.terms for w in words) - lacking)
    return max(least, 1)


def _spec(name: str) -> dict:
    def load() -> dict:
        with open(local_copy(name), encoding="utf-8") as file:
            return json.load(file) | {"chunks": {}}

    return once(f"decontamination {name}", load)


def sightings(docs: DataFrame, terms: str, identity: str, text: str) -> DataFrame:
    """`(doc_id, places array<int>, codes array<int>)`: where each text has the benchmark's terms, counted in words.

    Texts with fewer terms than any copy has are left out. A chunk of signs only is no word.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("places", pa.list_(pa.int32())), ("codes", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec = _spec(terms)
        known, codes = spec["chunks"], spec["terms"]
        for batch in batches:
            for block in blocks(batch, "text"):
                names, places, found = [], [], []
                for name, t in zip(block.column("id").to_pylist(), block.column("text").to_pylist()):
                    if name is None or not t:
                        continue
                    chunks = t.split()
                    row = [*map(known.get, chunks)]
                    if None in row:
                        if len(known) + len(chunks) > CACHE_CHUNKS:
                            known.clear()
                        for c in set(chunks):
                            if c not in known:
                                w = word(c)
                                known[c] = codes.get(w, -1) if w else -2
                        row = [known[c] for c in chunks]
                    row = np.array(row, np.int32)
                    row = row[row > -2]
                    at = np.flatnonzero(row >= 0)
                    if len(at) >= spec["least"]:
                        names.append(name)
                        places.append(at.astype(np.int32))
                        found.append(row[at])
                yield pa.record_batch([as_arrow(c, f.type) for c, f in zip((names, places, found), schema)], schema=schema)

    rows = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, places array<int>, codes array<int>")


def passages(batch: pa.RecordBatch, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`(row of the batch, first word, starts, codes)` of the passages with enough content terms; starts index codes."""
    lists = batch.column("codes")
    sizes = np.diff(np.asarray(lists.offsets))
    codes, places = np.asarray(lists.flatten()), np.asarray(batch.column("places").flatten())
    owner = np.repeat(np.arange(batch.num_rows), sizes)
    some = weight[codes] > 0
    codes, places, owner = codes[some], places[some], owner[some]
    # every word is in WINDOW / STRIDE windows; the first begin before the text
    reach = WINDOW // STRIDE
    first = (places // STRIDE)[:, None] - np.arange(reach)
    key = (owner.astype(np.int64)[:, None] * (1 << 32) + first + reach).ravel()
    code = np.repeat(codes, reach)
    order = np.argsort(key, kind="stable")
    key, code = key[order], code[order]
    cuts = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(np.append(cuts, len(key)))
    dense = n >= SHARED
    cells = np.repeat(dense, n)
    n, key = n[dense], key[cuts[dense]]
    return key >> 32, ((key & 0xFFFFFFFF) - reach) * STRIDE, np.cumsum(n) - n, code[cells]


def short_windows(places: np.ndarray, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`(owner and first word, code)` of the terms in windows for short items; the key is owner << 32 | first / STRIDE + 1."""
    reach = SHORT_WINDOW // STRIDE
    first = (places // STRIDE)[:, None] - np.arange(reach)
    key = (owner.astype(np.int64)[:, None] * (1 << 32) + first + 1).ravel()
    return key, np.repeat(codes, reach)


def _projected(codes: np.ndarray, starts: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sums of the matrix rows of each passage's terms."""
    if not len(starts):
        return np.zeros((0, matrix.shape[1]), matrix.dtype)
    return np.add.reduceat(matrix[codes], starts, axis=0)


def _test_matrix(terms: int, rank: int) -> np.ndarray:
    return np.random.default_rng(20).standard_normal((terms, rank)).astype(np.float32)


def sketch(seen: DataFrame, weights: str, terms: int, rank: int, part: int = 256) -> np.ndarray:
    """Z = A'(A W) over all passages: each task sums its own, and blocks of terms are added up across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.array(_spec(weights)["weight"], np.float32)
        test = _test_matrix(terms, rank) * weight[:, None]
        total = np.zeros((terms, rank), np.float32)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                _, _, starts, codes = passages(batch.slice(start, 2048), weight)
                y = _projected(codes, starts, test)
                n = np.diff(np.append(starts, len(codes)))
                order = np.argsort(codes, kind="stable")
                used, cuts = np.unique(codes[order], return_index=True)
                owner = np.repeat(np.arange(len(starts)), n)[order]
                for a in range(0, len(used), 512):  # bounded rows of y at a time
                    low = cuts[a]
                    high = cuts[a + 512] if a + 512 < len(used) else len(order)
                    if high > low:
                        total[used[a : a + 512]] += np.add.reduceat(y[owner[low:high]], cuts[a : a + 512] - low, axis=0)
        total *= weight[:, None]
        rows = [(k, total[k : k + part].tobytes()) for k in range(0, terms, part) if total[k : k + part].any()]
        yield pa.record_batch([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["k", "z"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in table.column("z").to_pylist())
        return pa.table({"k": pa.array([table.column("k")[0].as_py()], pa.int32()), "z": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    z = np.zeros((terms, rank))
    for row in seen.mapInArrow(run, "k int, z binary").groupBy("k").applyInArrow(add, "k int, z binary").collect():
        block = np.frombuffer(row["z"], np.float32).reshape(-1, rank)
        z[row["k"] : row["k"] + len(block)] = block
    return z


def right_singular_vectors(z: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """The leading eigenvectors of the Nystrom approximation of A'A from its sketch."""
    shift = 1e-6 * max(np.linalg.norm(z), 1e-12)
    z = z + shift * test
    core = test.T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max() * 1e-9
    u, s, _ = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return u[:, :rank][:, s[:rank] > s.max(initial=0) * 1e-6]


def common_words(item: list[str], text: list[str]) -> int:
    """Length of the longest common subsequence, one machine word operation for each word of the text."""
    masks: dict[str, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in text:
        if m := masks.get(w):
            hit = row & m
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def leak(item: list[str], near: list[str]) -> tuple[bool, float, bool]:
    """Whether the words near a candidate passage are the item: share of the subsequence, and whether its end is there."""
    share = common_words(item, near) / len(item)
    end = item[-END_WORDS:]
    answered = common_words(end, near) >= END_SHARE * len(end)
    return share >= SURE or (share >= LIKELY and answered), share, answered


def short_leak(item: list[str], near: list[str]) -> tuple[bool, float, bool]:
    """`leak` of a short item in the best span of its length and a sixth more; spans begin at words of the item."""
    span, own, best = len(item) + len(item) // 6, set(item), (False, 0.0, False)
    for k, w in enumerate(near):
        if w in own:
            yes, share, answered = leak(item, near[k : k + span])
            best = max(best, (yes and (share >= SURE or len(item) > END_WORDS), share, answered))
    return best


def _one_pass(spark: SparkSession, docs: DataFrame, items: list[tuple[int, str]], identity: str, text: str) -> DataFrame | None:
    vocabulary = Vocabulary(items)
    terms = vocabulary.terms
    if not terms:
        return None
    path = scratch_path(spark, "sightings")
    seen = sightings(docs, shipped(spark, "terms", json.dumps({"terms": terms, "least": least_sightings(vocabulary)}).encode()), identity, text)
    seen.write.parquet(path)
    seen = spark.read.schema("doc_id long, places array<int>, codes array<int>").parquet(path)

    # passages of each term and in all, counted over the whole corpus
    apart = F.array_distinct(F.zip_with("places", "codes", lambda p, c: F.floor(p / WINDOW) * (1 << 24) + c))
    frequency = np.zeros(len(terms))
    for row in seen.select(F.explode(apart).alias("x")).groupBy((F.col("x") % (1 << 24)).alias("code")).count().collect():
        frequency[row["code"]] = row["count"]
    number = docs.select(F.sum(F.ceil((F.length(text) + 1) / (6 * WINDOW))).alias("n")).first()["n"] or 0
    number = float(number) + len(items)
    weight = np.log((1 + number) / (1 + np.minimum(frequency, number)))
    content = frequency <= max(CONTENT_LEAST, CONTENT_SHARE * number)
    codes = [[terms[w] for w in words if w in terms] for _, words in vocabulary.items]
    for own in codes:
        present = [c for c in set(own) if frequency[c]]  # a term that is nowhere finds nothing
        content[sorted(present, key=lambda c: (frequency[c], c))[:RAREST]] = True
    weight = np.where(content, np.maximum(weight, 1e-3), 0).astype(np.float32)

    rank = min(RANK, len(terms), len(codes) + SURPLUS)
    test = _test_matrix(len(terms), rank).astype(np.float64)
    z = sketch(seen, shipped(spark, "weights", json.dumps({"weight": weight.tolist()}).encode()), len(terms), rank)
    for own in codes:
        np.add.at(z, own, ITEM_WEIGHT**2 * np.outer(weight[own], weight[own] @ test[own]))
    basis = right_singular_vectors(z, test, rank)
    latent = np.array([weight[own] @ basis[own] for own in codes])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    blob = np.concatenate([basis * weight[:, None], latent]).astype(np.float32)
    model = shipped(spark, "latent", blob.tobytes())
    description = {"weight": weight.tolist(), "rank": basis.shape[1], "items": vocabulary.items, "terms": terms, "frequency": frequency.tolist()}
    described = shipped(spark, "items", json.dumps(description).encode())

    def matrices() -> tuple[np.ndarray, np.ndarray, SharedTerms]:
        spec = _spec(described)
        raw = np.fromfile(local_copy(model), np.float32).reshape(-1, spec["rank"])
        return raw[: len(spec["weight"])], raw[len(spec["weight"]) :], SharedTerms(spec["items"], spec["terms"], np.array(spec["frequency"]))

    found = pa.schema([("doc_id", pa.int64()), ("item", pa.int32()), ("first", pa.int32()), ("cosine", pa.float64()), ("kind", pa.int32())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.array(_spec(described)["weight"], np.float32)
        project, items_, shared = once(f"latent {model}", matrices)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                row, first, starts, codes = passages(part, weight)
                y = _projected(codes, starts, project)
                y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
                cosine = y @ items_.T
                which, item = np.nonzero(cosine >= COSINE)
                names = np.asarray(part.column("doc_id"))
                columns = [(names[row[which]], item, first[which], cosine[which, item], np.full(len(which), LATENT))]

                lists = part.column("codes")
                codes, places = np.asarray(lists.flatten()), np.asarray(part.column("places").flatten())
                owner = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(lists.offsets)))
                text_, item = shared.pairs(owner, codes)
                short = shared.short[item]
                # longer items: the best passage of the text
                edges = np.searchsorted(row, [text_[~short], text_[~short] + 1]).T
                best = [cosine[a:b, i].max(initial=0) for (a, b), i in zip(edges, item[~short])]
                columns.append((names[text_[~short]], item[~short], np.zeros(len(best)), best, np.full(len(best), VERBATIM)))
                # short ones: windows of the texts that may hold one
                some = np.isin(owner, text_[short])
                key, code = short_windows(places[some], codes[some], owner[some])
                key, group = np.unique(key, return_inverse=True)
                window, item = shared.pairs(group, code)
                window, item = window[shared.short[item]], item[shared.short[item]]
                hit, place = np.unique(window, return_inverse=True)
                order = np.argsort(group, kind="stable")
                order = order[np.isin(group[order], hit)]
                y = _projected(code[order], np.searchsorted(group[order], hit), project)
                y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
                like = (y[place] * items_[item]).sum(axis=1)
                begin = ((key[window] & 0xFFFFFFFF) - 1) * STRIDE
                columns.append((names[key[window] >> 32], item, begin, like, np.full(len(item), NEAR)))
                columns = [np.concatenate([np.asarray(c) for c in x]) for x in zip(*columns)]
                columns[2] = columns[2].astype(np.int32)
                yield pa.record_batch([as_arrow(c, f.type) for c, f in zip(columns, found)], schema=found)

    candidates = seen.mapInArrow(search, "doc_id long, item int, first int, cosine double, kind int")
    candidates = candidates.groupBy("doc_id").agg(F.collect_list(F.struct("item", "first", "cosine", "kind")).alias("hits"))
    candidates = stored(candidates, "candidates")
    texts = suspected(docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text")), candidates, "doc_id")
    texts = texts.join(candidates, "doc_id")
    leaks = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answered", pa.bool_())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items_ = _spec(described)["items"]
        for batch in batches:
            for block in blocks(batch, "text"):
                out = []
                for name, t, hits in zip(*(block.column(c).to_pylist() for c in ("doc_id", "text", "hits"))):
                    words, whole, whole_text = [w for w in map(word, (t or "").split()) if w], set(), None
                    for h in sorted(hits, key=lambda h: -h["cosine"]):
                        if h["item"] in whole:
                            continue  # found word by word, with a greater cosine
                        item_id, item = items_[h["item"]]
                        if h["kind"] == VERBATIM:
                            whole_text = whole_text or f" {' '.join(words)} "
                            yes, share, answered = f" {' '.join(item)} " in whole_text, 1.0, True
                        elif h["kind"] == NEAR:
                            yes, share, answered = short_leak(item, words[max(0, h["first"]) : h["first"] + SHORT_WINDOW])
                        else:
                            yes, share, answered = leak(item, words[max(0, h["first"] - len(item)) : h["first"] + WINDOW + len(item)])
                        if yes:
                            if share == 1.0:
                                whole.add(h["item"])
                            out.append((name, item_id, h["cosine"], share, answered))
                yield pa.record_batch([pa.array([r[k] for r in out], f.type) for k, f in enumerate(leaks)], schema=leaks)

    rows = texts.select("doc_id", "text", "hits").mapInArrow(verify, "doc_id long, item_id long, cosine double, lcs double, answered boolean")
    best = F.max(F.struct("lcs", "cosine", "answered")).alias("best")
    return rows.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.lcs", "best.answered")


def pass_starts(hashes: np.ndarray, words: np.ndarray) -> list[int]:
    """The least hashes of the second and later passes.

    No pass has more items than the basis has directions for, nor more words than WORDS_A_PASS unless one item has.
    """
    most = max(1, min(ITEMS_A_PASS // 2, RANK - SURPLUS))
    starts, items, total = [], 0, 0
    for k in np.argsort(hashes, kind="stable").tolist():
        if items and (items == most or total + words[k] > WORDS_A_PASS):
            starts.append(int(hashes[k]))
            items, total = 0, 0
        items, total = items + 1, total + int(words[k])
    return sorted(set(starts))


def leaks(docs: DataFrame, benchmark: DataFrame, identity: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """`(doc_id, item_id, cosine, lcs, answered)`: every document that holds a benchmark item, with its best passage.

    NULL or empty texts on either side take no part, nor do rows without an id. Items of one id are looked for each.
    Repeated rows of a document give one result. An empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    known = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).distinct()
    known = known.withColumn("h", F.xxhash64("i", "t"))
    sizes = known.select("h", F.size(F.split("t", r"\s+")).alias("n")).toArrow()
    starts = pass_starts(np.asarray(sizes.column("h")), np.asarray(sizes.column("n")))
    passes = len(starts) + 1
    out: DataFrame | None = None
    for low, high in zip([None, *starts], [*starts, None]):
        share = known if low is None else known.filter(F.col("h") >= low)
        share = share if high is None else share.filter(F.col("h") < high)
        part = _one_pass(spark, docs, sorted((r["i"], r["t"]) for r in share.collect()), identity, text)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, answered boolean")
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs", "cosine", "answered")).alias("best")).select("doc_id", "item_id", "best.cosine", "best.lcs", "best.answered") if passes > 1 else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, of documents that hold no benchmark item."""
    return without(docs, stored(leaks(docs, benchmark, identity, text).select(F.col("doc_id").alias(identity)), "leaks"), identity)
