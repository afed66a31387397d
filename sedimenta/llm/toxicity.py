"""Toxicity by positive-unlabelled learning: confirmed toxic texts against unlabelled ones, with a risk held non-negative.

Labels of harmless texts are used for the class prior only. With prior p and classifier f the risk is
p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)]): what the unlabelled texts cost as negatives, less what the toxic ones
among them cost; where the difference turns negative the step undoes overfitting instead.
"""

from __future__ import annotations

import json
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import blocks, learnable, local_copy, mapped, once, shipped, texts_of, thinned

#: Rows of each kind that are learned from, and classifiers that vote: bounds on the driver's work.
TOXIC_ROWS, PLAIN_ROWS, MEMBERS = 4_000, 8_000, 3
BUCKETS = 1 << 20
#: A feature is considered when so many standard errors more frequent in toxic texts, in so many of them, and when
#: by the class prior so much of its occurrences is in toxic texts. All that pass are used: the sample bounds their number.
EXCESS, LEAST_TEXTS, PURITY = 6.0, 4, 0.6
CACHE_CHUNKS, SAMPLE_CHUNKS = 150_000, 20_000
#: Features of the sample that the driver handles at a time.
PIECE = 1 << 18
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def chunk_features(chunk: str) -> list[int]:
    """Hashed features of a chunk without white space: its words, and the beginnings of longer ones."""
    out = []
    for word in _NOT_LETTERS.split(chunk.lower()):
        if word:
            out.append(crc32(word.encode()) & (BUCKETS - 1))
            out += [crc32(word[:n].encode(), n) & (BUCKETS - 1) for n in range(4, min(9, len(word)))]
    return out


class _Features:
    """Features of texts as sets; remembers chunks. With `chosen`, only those features.

    What several different chunks of a text share is a feature of its own, at `BUCKETS` above the plain one:
    stems that also begin harmless words betray themselves by their number.
    """

    def __init__(self, chosen: set[int] | None = None, cache: int = CACHE_CHUNKS):
        self.chosen, self.cache = chosen, cache
        self.wanted = None if chosen is None else {x % BUCKETS for x in chosen}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, text: str) -> set[int]:
        chunks = set(text.split())
        known = self.known
        missing = chunks.difference(known)
        if missing:
            if len(known) + len(missing) > self.cache:
                known.clear()
                missing = chunks
            for c in missing:
                found = chunk_features(c)
                known[c] = tuple(found) if self.wanted is None else tuple(x for x in found if x in self.wanted)
        once_: set[int] = set()
        twice: set[int] = set()
        for xs in filter(None, map(known.__getitem__, chunks)):
            twice.update(x + BUCKETS for x in once_.intersection(xs))
            once_.update(xs)
        found = once_ | twice
        return found if self.chosen is None else found & self.chosen


def risk_step(f_pos: np.ndarray, f_unl: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The risk with logistic loss, and its derivatives by the scores of toxic and unlabelled texts."""
    s_pos, s_unl = _sigmoid(f_pos), _sigmoid(f_unl)
    n_pos, n_unl = max(len(f_pos), 1), max(len(f_unl), 1)
    soft = lambda x: np.logaddexp(0, x)
    positive = prior * soft(-f_pos).sum() / n_pos
    negative = soft(f_unl).sum() / n_unl - prior * soft(f_pos).sum() / n_pos
    d_pos = -prior * (1 - s_pos) / n_pos
    d_neg_pos, d_neg_unl = -prior * s_pos / n_pos, s_unl / n_unl
    if negative >= 0:
        return positive + negative, d_pos + d_neg_pos, d_neg_unl
    return positive, -d_neg_pos, -d_neg_unl


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Classifier:
    """A linear classifier of the presence of chosen features."""

    def __init__(self, features: list[int], weights: np.ndarray, bias: np.ndarray):
        self.features, self.weights, self.bias = features, weights, bias
        self.own = _Features(set(features))
        self.by = {x: i for i, x in enumerate(features)}

    def pack(self) -> bytes:
        return json.dumps({"features": self.features, "weights": self.weights.tolist(), "bias": self.bias.tolist()}).encode()

    @classmethod
    def load(cls, path: str) -> Classifier:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        return cls(spec["features"], np.array(spec["weights"]).reshape(len(spec["bias"]), -1), np.array(spec["bias"]))

    def scores(self, texts: list[str]) -> list[float]:
        out = []
        for text in texts:
            rows = [self.by[x] for x in sorted(self.own.of(text))]
            out.append(float(_sigmoid(self.bias + self.weights[:, rows].sum(axis=1)).mean()))
        return out


class Presence:
    """The features of texts, one array for all of them: little memory for a large sample."""

    def __init__(self, sizes: np.ndarray, features: np.ndarray):
        self.n, self.sizes, self.features = len(sizes), sizes, features

    def counts(self) -> np.ndarray:
        total = np.zeros(2 * BUCKETS, np.int64)
        for start in range(0, len(self.features), PIECE):
            total += np.bincount(self.features[start : start + PIECE], minlength=2 * BUCKETS)
        return total

    def cells(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and column of the features that have a column."""
        at, columns = [np.zeros(0, np.int64)], [place[:0]]
        for start in range(0, len(self.features), PIECE):
            own = place[self.features[start : start + PIECE]]
            some = np.flatnonzero(own >= 0)
            at.append(some + start)
            columns.append(own[some])
        return np.searchsorted(np.cumsum(self.sizes), np.concatenate(at), "right"), np.concatenate(columns)


def fit(positive: Presence, unlabelled: Presence, prior: float, members: int = MEMBERS, steps: int = 400, seed: int = 0) -> Classifier:
    """Each member learns from all toxic texts and its own share of the unlabelled ones, for a smaller variance."""
    p, n_p = positive.counts(), max(positive.n, 1)
    several = np.flatnonzero(p >= LEAST_TEXTS)
    p, rate = p[several], (unlabelled.counts()[several] + 1) / (unlabelled.n + 2)
    excess = (p / n_p - rate) / np.sqrt(rate * (1 - rate) / n_p)
    purity = prior * (p / n_p) / rate
    features = several[(excess > EXCESS) & (purity >= PURITY)]
    if not positive.n or not unlabelled.n:
        features = features[:0]
    place = np.full(2 * BUCKETS, -1, np.int32)
    place[features] = np.arange(len(features))
    rows_p, cols_p = positive.cells(place)
    all_rows, all_cols = unlabelled.cells(place)

    weights, biases = [], []
    rnd = np.random.default_rng(seed)
    for k in range(members):
        mine = rnd.integers(0, members, unlabelled.n) != k
        number, some = np.cumsum(mine) - 1, mine[all_rows]
        rows_u, cols_u, n_u = number[all_rows[some]], all_cols[some], int(mine.sum())
        w, b = np.zeros(len(features)), float(np.log(prior / (1 - prior)))
        m = v = np.zeros(len(features) + 1)
        for step in range(1, steps + 1 if len(features) else 1):
            f_p = b + np.bincount(rows_p, w[cols_p], positive.n)
            f_u = b + np.bincount(rows_u, w[cols_u], n_u)
            _, g_p, g_u = risk_step(f_p, f_u, prior)
            g = np.bincount(cols_p, g_p[rows_p], len(features)) + np.bincount(cols_u, g_u[rows_u], len(features)) + 1e-5 * w
            g = np.append(g, g_p.sum() + g_u.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        scale, shift = calibrate(b + np.bincount(rows_p, w[cols_p], positive.n), b + np.bincount(rows_u, w[cols_u], n_u), prior)
        weights.append(scale * w)
        biases.append(scale * b + shift)
    return Classifier(features.tolist(), np.array(weights).reshape(members, -1), np.array(biases))


def calibrate(f_pos: np.ndarray, f_unl: np.ndarray, prior: float, steps: int = 1500) -> tuple[float, float]:
    """Scale and shift of the scores by the same risk, so that they read as probabilities."""
    if not len(f_pos) or not len(f_unl) or np.ptp(np.concatenate([f_pos, f_unl])) == 0:
        return 1.0, 0.0
    scale, shift = 1.0, 0.0
    m = v = np.zeros(2)
    for step in range(1, steps + 1):
        _, g_p, g_u = risk_step(scale * f_pos + shift, scale * f_unl + shift, prior)
        g = np.array([g_p @ f_pos + g_u @ f_unl, g_p.sum() + g_u.sum()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        scale, shift = np.array([scale, shift]) - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        scale = max(scale, 0.1)
    return float(scale), float(shift)


def training_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int, plain_rows: int, identity: str, text: str) -> DataFrame:
    """`(_id, toxic boolean, features array<int>)`: bounded samples, by a hash of the id, of toxic rows and of all rows.

    The second sample is unlabelled: toxic rows are in it at their share. Ids alone are ranked, and the few
    chosen ones are sent to the texts.
    """
    toxic = labels.filter(F.col("toxic") == 1).select(F.col(identity).alias("_id")).distinct()
    own = docs.filter(learnable(identity, 3, 1)).select(F.col(identity).alias("_id"), F.col(text).alias("text"))
    ids = own.select("_id").distinct()
    rank = F.xxhash64(F.col("_id").cast("string"))
    confirmed = thinned(ids.join(toxic, "_id", "left_semi").withColumn("toxic", F.lit(True)), "toxic", toxic_rows, rank)
    plain = thinned(ids.withColumn("toxic", F.lit(False)), "toxic", plain_rows, rank)
    confirmed, plain = confirmed.orderBy(rank, "_id").limit(toxic_rows), plain.orderBy(rank, "_id").limit(plain_rows)
    sample = own.join(F.broadcast(confirmed.unionByName(plain)), "_id")

    def work(batch: pa.RecordBatch) -> dict:
        features = once("toxicity features", lambda: _Features(cache=SAMPLE_CHUNKS))
        found = [np.sort(np.fromiter(features.of(t), np.int32)) for t in texts_of(batch, "text")]
        return {"_id": batch.column("_id"), "toxic": batch.column("toxic"), "features": found}

    kind = docs.schema[identity].dataType.simpleString()
    return mapped(sample.select("_id", "toxic", "text"), f"_id {kind}, toxic boolean, features array<int>", work, "text")


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, plain_rows: int = PLAIN_ROWS, identity: str = "doc_id", text: str = "text") -> Classifier:
    """Learns from rows whose crc32(id) mod 3 is not 1. Without toxic rows every score is the prior's lower bound."""
    known = labels.filter(learnable(identity, 3, 1) & F.col("toxic").isNotNull())
    count = known.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("t")).first()
    prior = min(0.5, max(1e-3, (count["t"] or 0) / max(count["n"], 1)))
    rows = training_rows(docs, labels, toxic_rows, plain_rows, identity, text).toArrow()
    kinds = {}
    for kind in (True, False):
        own = rows.filter(rows.column("toxic") if kind else pc.invert(rows.column("toxic")))
        own = own.sort_by("_id").column("features").combine_chunks()
        kinds[kind] = Presence(np.asarray(pc.list_value_length(own)), np.asarray(own.flatten()))
    del rows, own
    return fit(kinds[True], kinds[False], prior)


def ship(spark: SparkSession, classifier: Classifier) -> str:
    return shipped(spark, "toxicity", classifier.pack())


def _loaded(name: str) -> Classifier:
    return once(f"toxicity {name}", lambda: Classifier.load(local_copy(name)))


def score(docs: DataFrame, model: str, threshold: float = 0.7, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, score, predicted)` of every row, from its whole text; an empty or NULL text has the score of no feature."""
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        scores = _loaded(model).scores(texts_of(batch, text))
        return {identity: batch.column(identity), "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return mapped(docs.select(identity, text), f"`{identity}` {kind}, score double, predicted int", work, text)


def keep_harmless(docs: DataFrame, model: str, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch, text):
                scores = _loaded(model).scores(texts_of(block, text))
                yield block.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
