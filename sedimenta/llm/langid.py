"""Language identification: a bidirectional gated recurrent network over bytes labels every position of a text."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import learnable, local_copy, mapped, once, shipped, thinned

#: Bytes that share one recurrent state; every byte of a text is in exactly one window.
WINDOW = 64
HIDDEN = 8
#: Labelled rows of each language that are learned from, each with its whole text: a bound on the driver's work.
TRAIN_ROWS = 100
BATCH = 4096
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")  # category L, as in the training rows: no fraction, superscript or numeral is one


class BiGRU:
    """Two gated recurrent layers, one from either end, and a softmax over their joint state.

    z, r = sigmoid(W[byte] + U h), n = tanh(W[byte] + r * (U h)), h' = n + z (h - n). Arrays have the units
    first, so each gate is one contiguous block.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.hidden = weights["Uf"].shape[1]
        self.labels = weights["bo"].shape[0]

    @classmethod
    def fresh(cls, labels: int, hidden: int = HIDDEN, seed: int = 0) -> BiGRU:
        rnd = np.random.default_rng(seed)
        draw = lambda *shape, by: (rnd.standard_normal(shape) * by).astype(np.float32)
        w = {"Wo": draw(labels, 2 * hidden, by=0.3), "bo": np.zeros(labels, np.float32)}
        for d in "fb":
            w |= {f"W{d}": draw(256, 3 * hidden, by=0.3), f"U{d}": draw(3 * hidden, hidden, by=0.5 / np.sqrt(hidden)), f"c{d}": np.zeros(hidden, np.float32)}
        return cls(w)

    def _run(self, d: str, codes: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """The states `(time, hidden, batch)` of one direction; masked positions have state 0."""
        W, U, c, H = self.w["W" + d], self.w["U" + d], self.w["c" + d][:, None], self.hidden
        T, B = codes.shape
        states = np.empty((T, H, B), np.float32)
        h = np.zeros((H, B), np.float32)
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            x = W[codes[t]].T
            g = U @ h
            zr = g[: 2 * H]
            zr += x[: 2 * H]
            np.multiply(zr, 0.5, out=zr)
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            un = g[2 * H :]
            un += c
            n = zr[H:] * un
            n += x[2 * H :]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((t, h, zr.copy(), un.copy(), n))
            new = states[t]
            np.subtract(h, n, out=new)
            new *= zr[:H]
            new += n
            if mask is not None:
                new *= mask[t]
            h = new
        return states

    def probabilities(self, codes: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """`(time, labels, batch)`: the label distribution of every position."""
        H = self.hidden
        out = np.matmul(self.w["Wo"][:, :H], self._run("f", codes, mask))
        out += np.matmul(self.w["Wo"][:, H:], self._run("b", codes, mask))
        out += self.w["bo"][:, None]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def gradients(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of all positions, and its gradients by backpropagation through time."""
        H, T = self.hidden, len(codes)
        tape: dict[str, list] = {"f": [], "b": []}
        states = {d: self._run(d, codes, mask, tape[d]) for d in "fb"}
        logits = np.matmul(self.w["Wo"][:, :H], states["f"]) + np.matmul(self.w["Wo"][:, H:], states["b"]) + self.w["bo"][:, None]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        here = np.arange(codes.shape[1])
        total = float(mask.sum())
        loss = -float((np.log(np.maximum(p[:, label, here], 1e-9)) * mask).sum()) / total
        p[:, label, here] -= 1
        p *= mask[:, None, :] / total
        g = {"bo": p.sum(axis=(0, 2)), "Wo": np.concatenate([np.einsum("tlb,thb->lh", p, states[d], optimize=True) for d in "fb"], axis=1)}
        for k, d in enumerate("fb"):
            U = self.w["U" + d]
            dU, dW, dc = np.zeros_like(U), np.zeros_like(self.w["W" + d]), np.zeros(H, np.float32)
            above = np.matmul(self.w["Wo"][:, k * H : (k + 1) * H].T, p)
            dh = np.zeros_like(states[d][0])
            for t, h, zr, un, n in reversed(tape[d]):
                dh = (dh + above[t]) * mask[t]
                z, r = zr[:H], zr[H:]
                dn = dh * (1 - z) * (1 - n * n)
                dr = dn * un * r * (1 - r)
                dz = dh * (h - n) * z * (1 - z)
                dun = dn * r
                dc += dun.sum(axis=1)
                into = np.concatenate([dz, dr, dun])
                dU += into @ h.T
                gates = np.concatenate([dz, dr, dn])
                for j in range(3 * H):
                    dW[:, j] += np.bincount(codes[t], gates[j], minlength=256)
                dh = dh * z + U.T @ into
            g |= {"U" + d: dU, "W" + d: dW, "c" + d: dc}
        return loss, g

    def fit(self, codes: np.ndarray, mask: np.ndarray, label: np.ndarray, epochs: int = 8, batch: int = 512, rate: float = 0.02, seed: int = 0) -> BiGRU:
        rnd = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        step, steps = 0, max(1, epochs * -(-codes.shape[1] // batch))
        for _ in range(epochs):
            order = rnd.permutation(codes.shape[1])
            for start in range(0, len(order), batch):
                some = order[start : start + batch]
                _, g = self.gradients(codes[:, some], mask[:, some], label[some])
                step += 1
                now = rate * (1 - 0.9 * step / steps)
                for k, grad in g.items():
                    np.clip(grad, -1, 1, out=grad)
                    m[k] += 0.1 * (grad - m[k])
                    v[k] += 0.01 * (grad * grad - v[k])
                    self.w[k] -= (now * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(size, windows)` byte codes, the lengths of the windows and the text each belongs to; whole texts, nothing left out."""
    counts = np.array([-(-len(t) // size) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    lengths = np.full(len(owner), size, np.int64)
    ends = np.cumsum(counts)
    for i, t in enumerate(texts):
        if len(t) % size:
            lengths[ends[i] - 1] = len(t) % size
    padded = b"".join([t + bytes(-len(t) % size) for t in texts])
    return np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(-1, size).T), lengths, owner


class Detector:
    def __init__(self, languages: list[str], net: BiGRU | None):
        self.languages, self.net = languages, net

    def pack(self) -> bytes:
        weights = {k: v.tolist() for k, v in self.net.w.items()} if self.net else None
        return json.dumps({"languages": self.languages, "weights": weights}).encode()

    @classmethod
    def load(cls, path: str) -> Detector:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        return cls(spec["languages"], BiGRU({k: np.array(v, np.float32) for k, v in spec["weights"].items()}) if spec["weights"] else None)

    def positions(self, texts: list[bytes]) -> list[np.ndarray]:
        """`(bytes, labels)` probabilities of each text."""
        codes, lengths, owner = windows(texts)
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for start in range(0, codes.shape[1], BATCH):
            some = slice(start, start + BATCH)
            p = self.net.probabilities(codes[:, some], (np.arange(WINDOW)[:, None] < lengths[some]).astype(np.float32))
            for k, (n, i) in enumerate(zip(lengths[some], owner[some])):
                parts[i].append(p[:n, :, k])
        return [np.concatenate(x) if x else np.zeros((0, len(self.languages)), np.float32) for x in parts]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """`(texts, labels)`: the mean of the probabilities of all positions."""
        codes, lengths, owner = windows(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        whole = lengths == WINDOW
        for full in (True, False):
            rows = np.flatnonzero(whole == full)
            for start in range(0, len(rows), BATCH):
                some = rows[start : start + BATCH]
                mask = None if full else (np.arange(WINDOW)[:, None] < lengths[some]).astype(np.float32)
                p = self.net.probabilities(np.ascontiguousarray(codes[:, some]), mask)
                each = p.sum(axis=0) if full else (p * mask[:, None, :]).sum(axis=0)
                for j in range(len(self.languages)):
                    sums[:, j] += np.bincount(owner[some], each[j], minlength=len(texts))
        return sums / np.maximum(np.array([len(t) for t in texts]), 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        raw = [(t or "").encode() for t in texts]
        lettered = [t is not None and _LETTER.search(t) is not None for t in texts]
        if not self.net:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        pooled = self.pooled([r if ok else b"" for r, ok in zip(raw, lettered)])
        best = pooled.argmax(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
        return names, [min(1.0, float(p[b])) if ok else 0.0 for p, b, ok in zip(pooled, best, lettered)]


def training_rows(docs: DataFrame, rows: int = TRAIN_ROWS, identity: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """`(lang, text)`: at most `rows` rows of each language, with their whole texts.

    Which rows depends on a hash of the id only, and of the text where ids repeat. Languages are thinned before the
    shuffle, so one with most of the table costs no more than the others.
    """
    hashed = F.xxhash64(F.col(identity).cast("string"))
    known = docs.filter(learnable(identity, 5, 0) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    small = thinned(known, lang, rows, hashed).select(F.col(lang).alias("lang"), F.col(text).alias("text"), hashed.alias("_h"), F.xxhash64(text).alias("_t"))
    first = Window.partitionBy("lang").orderBy("_h", "_t")
    return small.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= rows).select("lang", "text")


def train(docs: DataFrame, rows: int = TRAIN_ROWS, epochs: int = 8, **columns: str) -> Detector:
    """Learns from the text and language of documents whose crc32(id) mod 5 is not 0. No labelled row: everything is `und`."""
    sample = sorted((r["lang"], r["text"]) for r in training_rows(docs, rows, **columns).collect())
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Detector([], None)
    codes, lengths, owner = windows([text.encode() for _, text in sample])
    label = np.array([languages.index(lang) for lang, _ in sample])[owner]
    mask = (np.arange(WINDOW)[:, None] < lengths).astype(np.float32)
    return Detector(languages, BiGRU.fresh(len(languages)).fit(codes, mask, label, epochs))


def ship(spark: SparkSession, detector: Detector) -> str:
    return shipped(spark, "langid", detector.pack())


def _loaded(name: str) -> Detector:
    return once(f"langid {name}", lambda: Detector.load(local_copy(name)))


def identify(docs: DataFrame, model: str, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, lang_pred, score)` of every row, from its whole text.

    NULL texts and texts without a letter are `und` with score 0. Equal probabilities go to the language that
    sorts first. Repeated rows give repeated rows; further columns are left out.
    """
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        names, scores = _loaded(model).predict(batch.column(text).to_pylist())
        return {identity: batch.column(identity), "lang_pred": names, "score": scores}

    return mapped(docs.select(identity, text), f"`{identity}` {kind}, lang_pred string, score double", work, text)


def language_spans(docs: DataFrame, model: str, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """`(identity, spans array<struct<start, length, lang>>)`: runs of bytes with one label, over the whole text."""
    kind = docs.schema[identity].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        own, spans = _loaded(model), []
        raw = [(t or "").encode() for t in batch.column(text).to_pylist()]
        for p in own.positions(raw) if own.net else [np.zeros((0, 1))] * len(raw):
            label = p.argmax(axis=1)
            edges = np.flatnonzero(np.diff(label, prepend=-1)).tolist()
            spans.append([{"start": a, "length": b - a, "lang": own.languages[label[a]]} for a, b in zip(edges, [*edges[1:], len(label)])])
        return {identity: batch.column(identity), "spans": spans}

    schema = f"`{identity}` {kind}, spans array<struct<start: int, length: int, lang: string>>"
    return mapped(docs.select(identity, text), schema, work, text)


def keep_identified(docs: DataFrame, model: str, least: float, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is known with at least `least`; a reject is `und` or unsure."""
    from sedimenta.llm.common import blocks

    def run(batches):
        for batch in batches:
            for block in blocks(batch, text):
                names, scores = _loaded(model).predict(block.column(text).to_pylist())
                yield block.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
