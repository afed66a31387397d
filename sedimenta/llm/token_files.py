"""Token ids in binary shards: one concatenated id array, document boundaries and ids in Elias-Fano form."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.bpe import encoder
from sedimenta.llm.common import blocks, texts_of
from sedimenta.session import scratch_path

#: Ids after which a task closes its shard and opens the next; bounds a writer's and a reader's memory.
SHARD_IDS = 1 << 23
#: Most tasks that read shards.
READERS = 10_000
MAGIC = b"EFTOKEN1"
#: Ones between two stored positions of the upper bits.
SAMPLE = 256


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / n) bits a value, with constant-time select."""

    def __init__(self, low: np.ndarray, high: np.ndarray, samples: np.ndarray, n: int, width: int):
        self.low, self.high, self.samples, self.n, self.width = low, high, samples, n, width

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32), 0, 0)
        width = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        upper = np.zeros(int(ones[-1]) + 1, np.uint8)
        upper[ones] = 1
        return cls(low, np.packbits(upper, bitorder="little"), ones[::SAMPLE].astype(np.uint32), n, width)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The position of each wanted one: from the sample before it, byte by byte."""
        at = self.samples[ranks // SAMPLE].astype(np.int64)
        byte = at >> 3
        # ones still to pass, counted from the start of the sample's byte
        before = np.bitwise_count(self.high[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)).astype(np.int64)
        left = ranks % SAMPLE + before
        open_ = np.arange(len(ranks))
        while len(open_):
            count = np.bitwise_count(self.high[byte[open_]]).astype(np.int64)
            open_, count = open_[past := left[open_] >= count], count[past]
            left[open_] -= count
            byte[open_] += 1
        bits = np.unpackbits(self.high[byte][:, None], axis=1, bitorder="little")
        rank = np.cumsum(bits, axis=1) - 1
        inside = ((rank == left[:, None]) & (bits == 1)).argmax(axis=1)
        return (byte << 3) + inside

    def get(self, ranks: np.ndarray) -> np.ndarray:
        ranks = np.asarray(ranks, np.int64)
        if not len(ranks):
            return np.zeros(0, np.int64)
        value = (self.select(ranks) - ranks) << self.width
        first = ranks * self.width
        for bit in range(self.width):
            at = first + bit
            value |= (self.low[at >> 3].astype(np.int64) >> (at & 7) & 1) << bit
        return value

    def pack(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.width, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def unpack(cls, raw: memoryview) -> tuple[EliasFano, int]:
        n, width, low, high, samples = struct.unpack_from("<QBQQQ", raw)
        at = struct.calcsize("<QBQQQ")
        parts = np.frombuffer(raw, np.uint8, low, at), np.frombuffer(raw, np.uint8, high, at + low)
        end = at + low + high
        return cls(*parts, np.frombuffer(raw[end : end + 4 * samples], "<u4"), n, width), end + 4 * samples


def pack_shard(doc_ids: list[int | None], ids: list[bytes], vocabulary: int) -> bytes:
    """One shard: documents in order, those without an id first; ids take two bytes when the vocabulary allows."""
    width = 2 if vocabulary <= 1 << 16 else 4
    lengths = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
    named = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(named[0]) if len(named) else 0
    names = EliasFano.of((named - base).astype(np.uint64)).pack()
    ends = EliasFano.of(np.cumsum(lengths)).pack()
    head = MAGIC + struct.pack("<BQQqQQ", width, len(ids), len(ids) - len(named), base, len(names), len(ends))
    body = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}")
    return head + names + ends + bytes(-(len(head) + len(names) + len(ends)) % 4) + body.tobytes()


class Shard:
    """Reads a shard: any document's offset by select, its ids as a view of the file."""

    def __init__(self, raw: bytes | memoryview):
        raw = memoryview(raw)
        if bytes(raw[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token shard")
        shape = "<BQQqQQ"
        width, self.documents, self.nameless, self.base, names, ends = struct.unpack_from(shape, raw, len(MAGIC))
        at = len(MAGIC) + struct.calcsize(shape)
        self.names, _ = EliasFano.unpack(raw[at : at + names])
        self.ends, _ = EliasFano.unpack(raw[at + names : at + names + ends])
        at += names + ends
        self.ids = np.frombuffer(raw, f"<u{width}", offset=at + -at % 4)

    def bounds(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and end of each wanted document."""
        ends = self.ends.get(ranks)
        starts = np.zeros_like(ends)
        later = ranks > 0
        starts[later] = self.ends.get(ranks[later] - 1)
        return starts, ends

    def doc_ids(self, ranks: np.ndarray) -> list[int | None]:
        named = ranks >= self.nameless
        values = self.names.get(ranks[named] - self.nameless) + self.base
        out = np.full(len(ranks), None, object)
        out[named] = values.tolist()
        return out.tolist()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


MANIFEST = "part int, seq int, file string, documents long, ids long"


def write_shards(
    docs: DataFrame,
    folder: str,
    definition: str,
    end_id: int = 1,
    identity: str = "doc_id",
    text: str = "text",
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Writes all documents by ascending id into `folder`; returns the manifest, one row per shard, itself stored.

    A NULL or empty text has only its end id. Rows of one id are ordered by a hash of their text; rows
    without an id come first. A shard is written aside and renamed, so a task that is run again
    replaces it by the same bytes.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq = encoder(definition), TaskContext.get().partitionId(), 0
        end = end_id.to_bytes(4, "little")
        names: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal seq, size
            store, path = _open(f"{folder}/shard-{part:06d}-{seq:06d}.bin")
            aside = f"{path}.{uuid.uuid4().hex}"
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(aside) as out:
                out.write(pack_shard(names, ids, own.size))
            store.move(aside, path)
            row = [[part], [seq], [f"{folder}/shard-{part:06d}-{seq:06d}.bin"], [len(names)], [size // 4]]
            seq, size = seq + 1, 0
            names.clear()
            ids.clear()
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "seq", "file", "documents", "ids"])

        for batch in batches:
            for block in blocks(batch, "text"):
                for name, x in zip(block.column("id").to_pylist(), own.encode(texts_of(block, "text"))):
                    names.append(name)
                    ids.append(x + end)
                    size += len(x) + 4
                    if size >= 4 * shard_ids:
                        yield close()
        if names:
            yield close()

    manifest = scratch_path(spark, "shards")
    ordered.mapInArrow(run, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_shards(manifest: DataFrame) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32)` of every document, from the files alone."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    kinds = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                store, path = _open(uri)
                with store.open_input_file(path) as file:
                    shard = Shard(file.read_buffer())
                for first in range(0, shard.documents, 1 << 14):
                    ranks = np.arange(first, min(shard.documents, first + (1 << 14)))
                    starts, ends = shard.bounds(ranks)
                    sums = [crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [shard.doc_ids(ranks), starts + base, ends - starts, sums]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=kinds)

    # dealt out evenly, a file or a few to a task; few bytes stand for much work here
    tasks = min(max(1, manifest.count()), READERS)
    return based.select("file", "base").repartition(tasks).mapInArrow(run, schema)


def token_files(spark: SparkSession, docs: DataFrame, definition: str, end_id: int = 1) -> DataFrame:
    """Writes the documents' ids under the shared folder and reads them back."""
    return read_shards(write_shards(docs, scratch_path(spark, "tokens"), definition, end_id))
