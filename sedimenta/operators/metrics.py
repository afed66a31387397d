"""Ingest metrics and data checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.chunks import chunk_id
from sedimenta.operators.lookup import local_rows
from sedimenta.sources import fixed_values as fv
from sedimenta.sources.registry import Rule


def ingest_delta(before: DataFrame, now: DataFrame) -> DataFrame:
    """Counts before, now and their difference per table, plus the TOTAL row.

    Frames are `(tabla, filas)`. Tables that disappeared and tables that could
    not be counted (NULL) take part in nothing.
    """
    joined = (
        now.filter(F.col("filas").isNotNull())
        .select("tabla", F.col("filas").alias("ahora"))
        .join(before.select("tabla", F.col("filas").alias("antes")), "tabla", "left")
        .fillna(0, ["antes"])
    )
    return (
        joined.rollup("tabla")
        .agg(F.sum("antes").alias("antes"), F.sum("ahora").alias("ahora"), F.grouping("tabla").alias("_total"))
        .select(
            F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("tabla")).alias("tabla"),
            F.coalesce("antes", F.lit(0)).alias("antes"),
            F.coalesce("ahora", F.lit(0)).alias("ahora"),
            F.coalesce(F.col("ahora") - F.col("antes"), F.lit(0)).alias("delta"),
        )
        .withColumn("delta_texto", F.concat(F.when(F.col("delta") > 0, "+").otherwise(""), F.col("delta").cast("string")))
    )


def chunks_per_rule(chunks: DataFrame) -> DataFrame:
    """Generated chunks of each rule; chunks without a rule are counted under their own name."""
    rule = F.coalesce("regla_id", F.lit(fv.NO_RULE))
    return chunks.groupBy(rule.alias("regla_id")).agg(F.count("*").alias("chunks")).orderBy("regla_id")


def chunk_changes(stored_before: DataFrame, generated: DataFrame, stored_after: DataFrame) -> DataFrame:
    """One row: chunks before, generated, new, replaced, discarded and final.

    Ids are tagged by where they occur and met in one aggregation by id, which
    is combined before the shuffle. Nothing counts as discarded when the final
    store is empty.
    """
    key = F.col("chunk_clave")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    made = F.when(key.isNotNull() & (key != ""), chunk_id(key))
    tagged = (
        stored_before.select("chunk_id", one.alias("b"), none.alias("g"), none.alias("a"))
        .unionByName(generated.select(made.alias("chunk_id"), none.alias("b"), one.alias("g"), none.alias("a")))
        .unionByName(stored_after.select("chunk_id", none.alias("b"), none.alias("g"), one.alias("a")))
    )
    per_id = tagged.groupBy("chunk_id").agg(F.sum("b").alias("b"), F.sum("g").alias("g"), F.sum("a").alias("a"))
    known = F.col("chunk_id").isNotNull() & (F.col("g") > 0)
    kept = F.count_if(known & (F.col("a") > 0))
    total, final = F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0))
    return per_id.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("previos"),
        total.alias("generados"),
        F.count_if(known & (F.col("b") == 0)).alias("nuevos"),
        F.count_if(known & (F.col("b") > 0)).alias("reemplazos"),
        F.when(final > 0, F.greatest(F.lit(0), total - kept)).otherwise(F.lit(0)).alias("descartados"),
        final.alias("finales"),
    )


@dataclass(frozen=True)
class ChunkExpectation:
    """What a run must have produced for a rule."""

    rule: Rule
    min_chunks: int
    tags: dict[str, str]


# Smallest acceptable number of chunks per rule and overall.
SUITE_MIN_CHUNKS = {"P00001_M00001": 12, "P00002_M00002": 10, "P00003_M00003": 5, "P00004_M00004": 15}
SUITE_MIN_TOTAL = 55


def expectations(rules: Sequence[Rule], minimum: dict[str, int] = SUITE_MIN_CHUNKS) -> list[ChunkExpectation]:
    """Expectations of the given rules: their literal tags and declared personal columns."""
    return [
        ChunkExpectation(r, minimum[r.id], {k: v for k, v in r.tags.items() if not v.startswith("column:")}) for r in rules
    ]


def _faults(e: ChunkExpectation) -> tuple[Column, Column]:
    """Of a chunk of the rule: a required tag is wrong, the personal keys are not the declared ones."""
    wrong = F.lit(False)
    for name, value in e.tags.items():
        wrong = wrong | ~F.col("dimensiones")[name].eqNullSafe(F.lit(value))
    keys = F.array(*[F.lit(p) for p in sorted(e.rule.pii)]).cast("array<string>")
    return wrong, ~F.array_sort(F.map_keys("pii_tokens")).eqNullSafe(keys)


_COUNTS = ("chunks", "tags_erroneos", "pii_erronea")


def chunk_checks(chunks: DataFrame, expected: Sequence[ChunkExpectation], total_min: int | None = None) -> DataFrame:
    """Per expected rule, also without chunks: enough of them, tags as required, personal keys exactly as declared.

    `total_min` adds a TOTAL row with the overall minimum.
    """
    bad_tags, bad_keys = F.lit(False), F.lit(False)
    for e in expected:
        mine, (tags, keys) = F.col("regla_id") == e.rule.id, _faults(e)
        bad_tags, bad_keys = F.when(mine, tags).otherwise(bad_tags), F.when(mine, keys).otherwise(bad_keys)
    found = chunks.groupBy("regla_id").agg(
        F.count("*").alias("chunks"), F.count_if(bad_tags).alias("tags_erroneos"), F.count_if(bad_keys).alias("pii_erronea")
    )
    return _judged(found, expected, total_min)


def _judged(found: DataFrame, expected: Sequence[ChunkExpectation], total_min: int | None) -> DataFrame:
    declared = local_rows(found.sparkSession, [(e.rule.id, e.min_chunks) for e in expected], "regla_id string, min_chunks int")
    rows = declared.join(found, "regla_id", "left").fillna(0, [*_COUNTS]).select("regla_id", "min_chunks", *_COUNTS)
    if total_min is not None:
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]
        rows = rows.unionByName(rows.agg(*sums).select(F.lit("TOTAL").alias("regla_id"), F.lit(total_min).alias("min_chunks"), *_COUNTS))
    enough = F.col("chunks") >= F.col("min_chunks")
    return rows.withColumn("cumple", enough & (F.col("tags_erroneos") == 0) & (F.col("pii_erronea") == 0))


class WriteChecks:
    """The same checks, counted in the pass that writes the chunks: give it to a write, or several, then ask for the result.

    The counts are taken in the stage that writes, behind its shuffle, where Spark counts every task once even if a lost
    executor makes an earlier stage run again.
    """

    def __init__(self, expected: Sequence[ChunkExpectation], total_min: int | None = None):
        self.expected, self.total_min = expected, total_min
        self.observations: list[Observation] = []

    def watch(self, chunks: DataFrame) -> DataFrame:
        measured = [F.count(F.lit(1)).alias("filas")]
        for i, e in enumerate(self.expected):
            mine, (tags, keys) = F.col("regla_id").eqNullSafe(e.rule.id), _faults(e)
            measured += [F.count_if(x).alias(f"{c}{i}") for c, x in zip(_COUNTS, (mine, mine & tags, mine & keys))]
        self.observations.append(Observation())
        return chunks.observe(self.observations[-1], *measured)

    def _sum(self, name: str) -> int:
        return sum(o.get[name] for o in self.observations)

    def written(self) -> int:
        """Rows of the writes, chunks of further rules included; waits until they have ended."""
        return self._sum("filas")

    def result(self, spark: SparkSession) -> DataFrame:
        """What `chunk_checks` gives for the written chunks, without reading them."""
        rows = [(e.rule.id, *(self._sum(f"{c}{i}") for c in _COUNTS)) for i, e in enumerate(self.expected)]
        found = local_rows(spark, rows, "regla_id string, chunks long, tags_erroneos long, pii_erronea long")
        return _judged(found, self.expected, self.total_min)
