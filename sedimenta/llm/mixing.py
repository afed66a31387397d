"""Mixing sources to target weights: pivotal dependent rounding, combined through a reduction tree.

Every document of a source is to be taken target / size times. The whole part is certain; the fraction is a copy
probability, the same for all documents of the source. Pivotal rounding pairs two undecided documents and moves words
of expectation from one to the other, at random in the direction and just as far as makes one probability 0 or 1.
Each document keeps its expectation and each pair its expected words, so a source's words stay exact until one
document is left undecided. Documents are dealt into small groups that tasks round on their own; the one each
group leaves undecided goes to a group of the next level, until a source has one, which is rounded by itself.
Longest first: a long document is settled by the shorter ones after it, so what is left at the end is short.
"""

from __future__ import annotations

from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import stored
from sedimenta.operators.numbering import numbered

#: Documents that a group has on average, and undecided ones that meet on the next level.
GROUP = 512
#: Copies of equal documents that one task writes out.
COPIES = 1 << 16
#: Weights of sources in order, the share of all words that is taken, copies a document may have.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
_SPACES = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    """The number of maximal runs of other characters than blank and U+0009 to U+000D; 0 for NULL. Makes no list of them."""
    marks = F.regexp_replace(F.ltrim(text, F.lit(_SPACES)), r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", size: str = "source_size", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds `place` and `target` to one row per source: weights repeat over the sources in order of code points, NULL last.

    The share of all words is dealt by weight. Sources dealt more than `most` times their size keep that much, and the rest is dealt
    again among the others, until none is above. Only sums come to the driver: one small job for each round.
    """
    ranked = numbered(sizes, [F.col(source).asc_nulls_last()], None, "place", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    ranked = stored(ranked.withColumn("weight", weight), "weights")
    cap = most * F.col(size).cast("double")
    words = ranked.agg(F.sum(size)).first()[0] or 0
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level > cap
        capped, taken, free = ranked.agg(F.count_if(over), F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))).first()
        if capped == full or not free:
            break
        full, level = capped, (share * words - taken) / free
    return ranked.withColumn("target", F.least(cap, F.col("weight") * level)).drop("weight")


def _chance(*keys) -> float:
    """A number from 0 to under 1 that depends on the keys only."""
    return int.from_bytes(blake2b(repr(keys).encode(), digest_size=7).digest(), "little") / (1 << 56)


def settle(units: list[tuple], seed: int) -> tuple[dict[int, int], tuple[int, float] | None]:
    """Rounds `(key, size, mass)` one after the other: the copies (0 or 1) by position, and the position and mass left undecided.

    `mass` is the probability times the size. The heavier of two directions is the less likely one, so expectations stay.
    """
    copies: dict[int, int] = {}
    open_: tuple[int, float] | None = None
    for i, (key, size, mass) in enumerate(units):
        if mass <= 0 or mass >= size:
            copies[i] = int(mass > 0)
            continue
        if open_ is None:
            open_ = i, mass
            continue
        j, other = open_
        other_key, other_size, _ = units[j]
        up = min(other_size - other, mass)  # words that may move to the open one
        down = min(other, size - mass)
        if _chance(seed, other_key, key) * (up + down) < down:
            if up == mass:
                copies[i], open_ = 0, (j, other + mass)
                if other + mass >= other_size:
                    copies[j], open_ = 1, None
            else:
                copies[j], open_ = 1, (i, mass - up)
        elif down == other:
            copies[j], open_ = 0, (i, mass + other)
            if mass + other >= size:
                copies[i], open_ = 1, None
        else:
            copies[i], open_ = 1, (j, other - down)
    return copies, open_


_SCHEMA = pa.schema([("_s", pa.int64()), ("_id", pa.string()), ("_n", pa.int64()), ("size", pa.int64()), ("mass", pa.float64()), ("node", pa.int64()), ("copies", pa.int64())])
_ROW = "_s long, _id string, _n long, size long, mass double, node long, copies long"


def _rounded(units: DataFrame, level: int, last: Column, seed: int) -> DataFrame:
    """One level of the tree: groups `(_s, node)` are settled; `copies` is NULL for the one that goes on."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        # longest first; equal ones by a hash, so that ids in a row do not matter
        rows.sort(key=lambda r: (-r["size"], _chance(seed, r["_id"], r["_n"]), r["_id"] or "", r["_n"]))
        copies, open_ = settle([((r["_id"], r["_n"]), r["size"], r["mass"]) for r in rows], seed + level)
        for i, r in enumerate(rows):
            r["copies"] = copies.get(i)
        if open_:
            row = rows[open_[0]]
            row["mass"] = open_[1]
            if row["last"]:
                row["copies"] = int(_chance(seed, "last", row["_s"], row["_id"], row["_n"]) * row["size"] < open_[1])
        return pa.table({f.name: pa.array([r[f.name] for r in rows], f.type) for f in _SCHEMA}, schema=_SCHEMA)

    held = units.withColumn("last", last).groupBy("_s", "node").applyInArrow(run, _ROW)
    return stored(held, f"rounded{level}")


def mix(docs: DataFrame, identity: str = "doc_id", source: str = "source", text: str = "text", seed: int = 20, group: int = GROUP) -> DataFrame:
    """`(doc_id, size, source_size, target, taken)`, one row per input row.

    `taken` is a whole number of copies, at most MOST, times the size. Choices depend on ids, sizes and `seed` alone, so reruns
    agree however the rows are dealt. Rows of one id, source and size are documents of their own; a NULL id or source
    is a value like another. Texts that are NULL, empty or blank have size 0 and nothing is taken of them. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    kind = docs.schema[identity].dataType.simpleString()
    rows = docs.select(F.col(identity).alias("id"), F.col(source).alias("source"), words_of(F.col(text)).alias("size"))
    # equal rows are counted before anything is shuffled, and written out again by many tasks
    counted = stored(rows.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    sums = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("rows")).otherwise(0)).alias("many"))
    aims = targets(stored(sums, "sums")).withColumnsRenamed({"source": "_source", "place": "_s"})
    many = aims.agg(F.max("many")).first()[0] or 0

    parts = F.floor((F.col("rows") - 1) / F.lit(COPIES))
    spread = counted.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long"))))
    spread = spread.repartition("id", "source", "size", "_part")
    upto = F.least(F.lit(COPIES).cast("long"), F.col("rows") - F.col("_part") * COPIES)
    spread = spread.withColumn("_n", F.explode(F.sequence(F.col("_part") * COPIES, F.col("_part") * COPIES + upto - 1)))
    units = spread.join(aims, F.col("source").eqNullSafe(F.col("_source")))
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(per).cast("long")
    groups = F.ceil(F.col("many") / F.lit(group)).cast("long")
    units = units.select(
        "_s",
        F.col("id").cast("string").alias("_id"),
        "_n",
        "size",
        ((per - whole) * F.col("size")).alias("mass"),
        F.pmod(F.xxhash64(F.col("id").cast("string"), "_n", "size"), F.greatest(groups, F.lit(1).cast("long"))).alias("node"),
        F.lit(None).cast("long").alias("copies"),
    )
    done: DataFrame | None = None
    level, left = 0, -(-many // group)
    aim = aims.select("_s", "many").withColumnRenamed("_s", "_a")
    while True:
        # a source's groups on this level: the last when there is one
        alone = F.ceil(F.col("many") / F.lit(group ** (level + 1))) <= 1
        here = units.join(aim, F.col("_s") == F.col("_a")).drop("_a")
        now = _rounded(here, level, alone, seed)
        settled = now.filter(F.col("copies").isNotNull())
        done = settled if done is None else done.unionByName(settled)
        if left <= 1:
            break
        units = now.filter(F.col("copies").isNull()).withColumn("node", F.floor(F.col("node") / F.lit(group)).cast("long"))
        level, left = level + 1, -(-left // group)
    per_source = aims.select(F.col("_s").alias("_a"), "source_size", "target")
    out = done.join(per_source, F.col("_s") == F.col("_a"))
    copies = F.col("copies") + F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return out.select(F.col("_id").cast(kind).alias(identity), "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"))
