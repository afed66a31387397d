"""Text quality by a factorisation machine over hashed words, statistics of structure and metadata.

y = b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2): all pairs of features interact through their
factors, in time linear in their number. Every word of a text is a feature of value 1 / (number of words).
"""

from __future__ import annotations

import json
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import learnable, local_copy, mapped, once, shipped, texts_of, thinned

BUCKETS, FACTORS = 1 << 15, 8
#: Labelled rows of each class that are learned from: a bound on the driver's work.
TRAIN_ROWS = 3_000
CACHE_CHUNKS = 250_000
STATISTICS = "log_chars log_words word_length upper symbols digits long_bytes distinct repeats lines line_repeats closed".split()
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-")
_LONG = bytes(range(128, 256))
_CLOSED = re.compile(r"[.!?]\s*$", re.MULTILINE)


class Reader:
    """Words as buckets, and the statistics of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        chunks = text.split()
        known = self.known
        found = [*map(known.get, chunks)]
        if None in found:
            if len(known) + len(chunks) > CACHE_CHUNKS:
                known.clear()
            for c in set(chunks):
                if c not in known:
                    known[c] = crc32(c.lower().encode()) & (BUCKETS - 1)
            found = [known[c] for c in chunks]
        return np.array(found, np.int32)

    def statistics(self, text: str, words: np.ndarray) -> list[float]:
        raw = text.encode()
        size, n = max(len(raw), 1), max(len(words), 1)
        share = lambda kind: (len(raw) - len(raw.translate(None, kind))) / size
        lines = text.split("\n")
        return [
            np.log1p(len(text)), np.log1p(len(words)), len(text) / n, share(_UPPER), share(_SYMBOLS), share(_DIGITS), share(_LONG),
            len(np.unique(words)) / n, float((words[1:] == words[:-1]).sum()) / n, len(lines) / n,
            1 - len(set(lines)) / len(lines), len(_CLOSED.findall(text)) / len(lines),
        ]


def read(texts: list[str], reader: Reader) -> tuple[list[np.ndarray], np.ndarray]:
    words = [reader.words(t) for t in texts]
    return words, np.array([reader.statistics(t, w) for t, w in zip(texts, words)], np.float64).reshape(len(texts), len(STATISTICS))


class Machine:
    """`word` and `stat` have a row per feature: its weight, then its factors."""

    def __init__(self, bias: float, word: np.ndarray, stat: np.ndarray, mean: np.ndarray, spread: np.ndarray):
        self.bias, self.word, self.stat, self.mean, self.spread = bias, word, stat, mean, spread
        self.squares = word[:, 1:] ** 2

    def pack(self) -> bytes:
        values = {k: getattr(self, k).tolist() for k in ("stat", "mean", "spread")}
        used = np.flatnonzero(np.abs(self.word).sum(axis=1))
        return json.dumps(values | {"bias": self.bias, "used": used.tolist(), "word": self.word[used].tolist()}).encode()

    @classmethod
    def load(cls, path: str) -> Machine:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        word = np.zeros((BUCKETS, FACTORS + 1), np.float32)
        if spec["used"]:
            word[spec["used"]] = spec["word"]
        return cls(spec["bias"], word, *(np.array(spec[k]) for k in ("stat", "mean", "spread")))

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4)

    def parts(self, words: list[np.ndarray], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: weighted sum, sums of factors, sums of their squares."""
        n = np.array([len(w) for w in words])
        x = 1 / np.maximum(n, 1)
        flat = np.concatenate([*words, np.zeros(1, np.int32)])  # reduceat wants a value behind the last start
        starts = np.cumsum(n) - n
        some = (n > 0)[:, None]
        sums = np.where(some, np.add.reduceat(self.word[flat].astype(np.float64), starts, axis=0), 0) * x[:, None]
        squares = np.where(some, np.add.reduceat(self.squares[flat].astype(np.float64), starts, axis=0), 0) * (x * x)[:, None]
        z = self.scaled(stats)
        sums += z @ self.stat
        squares += (z * z) @ self.stat[:, 1:] ** 2
        return sums[:, 0], sums[:, 1:], squares

    def scores(self, words: list[np.ndarray], stats: np.ndarray) -> np.ndarray:
        if not words:
            return np.zeros(0)
        linear, factors, squares = self.parts(words, stats)
        return 0.5 * (1 + np.tanh(0.5 * (self.bias + linear + 0.5 * (factors**2 - squares).sum(axis=1))))


def fit(words: list[np.ndarray], stats: np.ndarray, label: np.ndarray, weight: np.ndarray, epochs: int = 12, batch: int = 256, seed: int = 0) -> Machine:
    """Weighted logistic loss, Adam over blocks of texts. One class only, or no rows: the score is the class's share."""
    rnd = np.random.default_rng(seed)
    mean = stats.mean(axis=0) if len(stats) else np.zeros(len(STATISTICS))
    spread = np.maximum(stats.std(axis=0) if len(stats) else np.ones(len(STATISTICS)), 1e-6)
    share = float((label * weight).sum() / weight.sum()) if len(label) else 0.5
    share = min(0.99, max(0.01, share))
    texts_with = np.bincount(np.concatenate([*(np.unique(w) for w in words), np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS)
    draw = lambda n: np.concatenate([np.zeros((n, 1)), rnd.standard_normal((n, FACTORS)) * 0.05], axis=1)
    word = draw(BUCKETS).astype(np.float32)
    word[texts_with < 5] = 0  # too rare to learn from
    machine = Machine(float(np.log(share / (1 - share))), word, draw(len(STATISTICS)), mean, spread)
    if len(np.unique(label)) < 2:
        machine.word[:], machine.stat[:] = 0, 0
        machine.squares = machine.word[:, 1:] ** 2
        return machine
    alive = (texts_with >= 5)[:, None]
    state = {k: (np.zeros_like(getattr(machine, k)), np.zeros_like(getattr(machine, k))) for k in ("word", "stat")}
    step = 0
    for _ in range(epochs):
        order = rnd.permutation(len(words))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            some = [words[i] for i in rows]
            z = machine.scaled(stats[rows])
            linear, factors, squares = machine.parts(some, stats[rows])
            y = machine.bias + linear + 0.5 * (factors**2 - squares).sum(axis=1)
            g = (0.5 * (1 + np.tanh(0.5 * y)) - label[rows]) * weight[rows] / weight[rows].sum()
            n = np.array([len(w) for w in some])
            x = np.repeat(1 / np.maximum(n, 1), n)
            flat, g_flat = np.concatenate([*some, np.zeros(0, np.int32)]), np.repeat(g, n)
            by_word = np.zeros(machine.word.shape)
            by_word[:, 0] = np.bincount(flat, g_flat * x, BUCKETS)
            own = np.bincount(flat, g_flat * x * x, BUCKETS)
            for f in range(FACTORS):
                by_word[:, f + 1] = np.bincount(flat, g_flat * x * np.repeat(factors[:, f], n), BUCKETS) - own * machine.word[:, f + 1]
            by_stat = np.concatenate([(z.T @ g)[:, None], z.T @ (g[:, None] * factors) - ((z * z).T @ g)[:, None] * machine.stat[:, 1:]], axis=1)
            step += 1
            for name, grad, rate in (("word", by_word * alive, 0.02), ("stat", by_stat + 1e-4 * machine.stat, 0.03)):
                m, v = state[name]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                target = getattr(machine, name)
                target -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(target.dtype)
            machine.squares = machine.word[:, 1:] ** 2
            machine.bias -= 0.05 * float(g.sum())
    return machine


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, identity: str = "doc_id", text: str = "text") -> Machine:
    """Learns from labelled rows whose crc32(id) mod 5 is not 0: at most `rows` of each class, weighted to the classes' true shares.

    Labels that disagree about an id count each.
    """
    known = labels.filter(learnable(identity, 5, 0) & F.col("quality").isin(0, 1)).select(F.col(identity).alias("_id"), F.col("quality").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rank = F.xxhash64(F.col("_id").cast("string"))
    first = Window.partitionBy("label").orderBy(rank, "_id")
    chosen = thinned(known, "label", rows, rank).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= rows).select("_id", "label")
    sample = docs.select(F.col(identity).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")

    def work(batch: pa.RecordBatch) -> dict:
        words, stats = read(texts_of(batch, "text"), once("quality reader", Reader))
        return {"_id": batch.column("_id"), "label": batch.column("label"), "words": words, "stats": list(stats)}

    kind = docs.schema[identity].dataType.simpleString()
    schema = f"_id {kind}, label int, words array<int>, stats array<double>"
    found = mapped(sample.select("_id", "label", "text"), schema, work, "text").toArrow().combine_chunks()
    found = found.sort_by([("_id", "ascending"), ("label", "ascending")])
    label = np.asarray(found.column("label")).astype(np.float64)
    weight = np.array([totals[x] / max(1, (label == x).sum()) for x in label])
    held = found.column("words").combine_chunks()
    words = np.split(np.asarray(held.flatten()), np.cumsum(np.asarray(pc.list_value_length(held)))[:-1]) if len(label) else []
    stats = np.asarray(found.column("stats").combine_chunks().flatten()).reshape(len(label), len(STATISTICS))
    return fit(words, stats, label, weight)


def ship(spark: SparkSession, machine: Machine) -> str:
    return shipped(spark, "quality", machine.pack())


def score(docs: DataFrame, model: str, threshold: float = 0.3, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, score, predicted)` of every row, from its whole text; an empty or NULL text is scored by its statistics."""
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        machine = once(f"quality {model}", lambda: Machine.load(local_copy(model)))
        scores = machine.scores(*read(texts_of(batch, text), once("quality reader", Reader)))
        return {identity: batch.column(identity), "score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return mapped(docs.select(identity, text), f"`{identity}` {kind}, score double, predicted int", work, text)
