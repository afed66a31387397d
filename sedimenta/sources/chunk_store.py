"""The chunk store: buckets by a prefix of the id, and an index from personal values to buckets.

A run reads and rewrites the buckets that its chunks or forgotten values fall in; the others keep their files. The index is
written with the chunks: keyed hashes of the personal values and the bucket they are in, split by the
beginning of the hash, so a request to forget reads a few of its folders and then the touched buckets only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.keys import hmac_sha256
from sedimenta.operators import chunks as ch
from sedimenta.operators.lookup import distinct_for_join, local_rows
from sedimenta.sources.versioned import CODEC, RUN, Build, VersionedTable

BUCKET, MARK = "cubo", "marca"
Watch = Callable[[DataFrame], DataFrame]
_INDEX = f"huella string, {BUCKET} string, {RUN} string, {MARK} string"


class ChunkStore:
    """Chunks under `base` in 16 ** `digits` buckets. `key` signs the index; `pii` names the map of personal values, if chunks have one."""

    def __init__(self, spark: SparkSession, base: str, key: bytes, digits: int = 2, pii: str = "pii_tokens"):
        self.spark, self.key, self.digits, self.pii = spark, key, digits, pii
        self.table = VersionedTable(spark, base, BUCKET)
        self.index = f"{base.rstrip('/')}.indice"

    def _bucket(self, identity: Column) -> Column:
        return F.coalesce(F.substring(identity, 1, self.digits), F.lit("sin_id"))

    def _entries(self, values: DataFrame) -> DataFrame:
        """Adds the keyed hash of `valor` and its beginning."""
        hashed = values.withColumn("huella", F.substring(hmac_sha256(F.col("valor"), self.key), 1, 32)).drop("valor")
        return hashed.withColumn(MARK, F.substring("huella", 1, 2))

    def _values(self, frame: DataFrame, column: str) -> list[str]:
        """The buckets or marks that occur: a number bounded by the layout."""
        return [r[0] for r in frame.select(column).distinct().collect() if r[0] is not None]

    def read(self, run: str | None) -> DataFrame | None:
        stored = self.table.read(run)
        return None if stored is None else stored.drop(BUCKET)

    def _write(self, chunks: DataFrame, run: str, previous: str | None, touched: list[str] | None, watch: Watch | None = None) -> DataFrame:
        """Replaces the touched buckets (all, if None), and writes the index of what now stands in them."""
        return self._write_parts([(chunks.withColumn(BUCKET, self._bucket(F.col("chunk_id"))), None)], run, previous, touched, watch)

    def _write_parts(
        self,
        parts: Sequence[tuple[DataFrame, Build | None]],
        run: str,
        previous: str | None,
        touched: list[str] | None,
        watch: Watch | None = None,
        placed: bool = False,
    ) -> DataFrame:
        out = self.table.replace_built(parts, run, previous, touched, watch, placed)
        if self.pii in out.columns:
            mine = self.table.read(run, [v for v, r in self.table.manifest(run).items() if r == run])
            held = mine.select(BUCKET, F.explode(self.pii).alias("_", "valor")).filter(F.col("valor").isNotNull())
            entries = self._entries(held.select(BUCKET, "valor").distinct())
            entries.hint("rebalance", MARK).write.mode("overwrite").option("compression", CODEC).partitionBy(MARK).parquet(f"{self.index}/{RUN}={run}")
        return out.drop(BUCKET)

    def load(self, chunks: DataFrame, run: str, watch: Watch | None = None) -> DataFrame:
        """A first store of all the given chunks, with every row of a repeated id. `watch` observes them as they are written."""
        return self._write(chunks, run, None, None, watch)

    def load_built(self, parts: Sequence[tuple[DataFrame, Column, Build]], run: str, watch: Watch | None = None) -> DataFrame:
        """`load` of chunks that are built where they are written, from parts `(rows, id of a row's chunk, build)`.

        Only the rows are shuffled. A build gives one chunk a row, of the same columns in all parts, and keeps the column `BUCKET`.
        """
        placed = [(rows.withColumn(BUCKET, self._bucket(identity)), build) for rows, identity, build in parts]
        return self._write_parts(placed, run, None, None, watch)

    def upsert(self, new: DataFrame, run: str, previous: str | None) -> DataFrame:
        """The store of `previous` with the new chunks, as `operators.chunks.upsert_chunks` gives it; only the buckets of new ids are read and written.

        `new` is read twice and should be stored. The same run may be repeated.
        """
        touched = self._values(new.select(self._bucket(F.col("chunk_id")).alias(BUCKET)), BUCKET)
        before = self.table.read(previous, touched)
        merged = ch.one_per_id(new) if before is None else ch.upsert_chunks(before.drop(BUCKET), new)
        return self._write(merged, run, previous, touched)

    def touched_by(self, people: DataFrame, previous: str) -> list[str]:
        """The buckets in which a value of `people(valor)` stands, from the index alone."""
        manifest = self.table.manifest(previous)
        wanted = self._entries(distinct_for_join(people.filter(F.col("valor").isNotNull()), "valor"))
        marks, runs = self._values(wanted, MARK), sorted(set(manifest.values()))
        if not marks or not runs:
            return []
        paths = [f"{self.index}/{RUN}={r}" for r in runs]
        index = self.spark.read.schema(_INDEX).option("basePath", self.index).parquet(*paths).filter(F.col(MARK).isin(marks))
        held = local_rows(self.spark, sorted(manifest.items()), f"{BUCKET} string, {RUN} string")
        return self._values(index.join(wanted, ["huella", MARK], "left_semi").join(held, [BUCKET, RUN], "left_semi"), BUCKET)

    def forget(self, people: DataFrame, run: str, previous: str) -> DataFrame:
        """The store of `previous` without the people, as `operators.chunks.forget` gives it; reads the index and the touched buckets only."""
        touched = self.touched_by(people, previous)
        left = ch.forget(self.table.read(previous, touched), people, (BUCKET,))
        return self._write_parts([(left, None)], run, previous, touched, placed=True)


class KeyedStore:
    """Encrypted chunks in two tables of the same buckets: bodies, and the wrapped data key of each. A rotation rewrites keys only."""

    KEY_FIELDS = ("dek_cifrada", "kek_version")

    def __init__(self, spark: SparkSession, base: str, digits: int = 2):
        self.bucket = F.coalesce(F.substring("chunk_id", 1, digits), F.lit("sin_id")).alias(BUCKET)
        self.bodies = VersionedTable(spark, base, BUCKET)
        self.keys = VersionedTable(spark, f"{base.rstrip('/')}.claves", BUCKET)

    def load(self, stored: DataFrame, run: str) -> DataFrame:
        """Stores what `production_view` gives, one row per id. Both tables derive a chunk's key from its id, so they agree though `stored` is computed twice."""
        self.bodies.replace(stored.drop(*self.KEY_FIELDS).select("*", self.bucket), run, None)
        self.keys.replace(stored.select("chunk_id", *self.KEY_FIELDS, self.bucket), run, None)
        return self.read(run, run)

    def read(self, bodies: str, keys: str) -> DataFrame:
        """Bodies as of one run with the keys as of another. The join carries the bucket, so both sides prune alike."""
        joined = self.bodies.read(bodies).join(self.keys.read(keys), ["chunk_id", BUCKET], "left")
        return joined.drop(BUCKET)

    def rotate(self, wrapping_keys: Mapping[str, bytes], version: str, run: str, previous: str) -> list[str]:
        """Wraps keys of other versions anew and returns the buckets that had some; no body is read, no other bucket's file written."""
        held = self.keys.read(previous)
        stale = held.filter(~F.col("kek_version").eqNullSafe(version)).select(BUCKET).distinct()
        touched = sorted(r[0] for r in stale.collect())
        self.keys.replace(ch.rotate_wrapping(self.keys.read(previous, touched), wrapping_keys, version), run, previous, touched)
        return touched
