"""A Merkle manifest of a data set: trees per source, one tree over the sources, proofs climbed by a recursive query.

Leaves are numbered in their source without one task that sees a source whole. Levels are built HOP at a time: the
FAN ** HOP nodes of a block meet in one group, which hashes up to HOP levels and stores, for each of its nodes, a link to
the node above the block and the siblings on the way there. The roots of the sources are the lowest nodes of a last
tree of the same form. A recursive query starts at the leaves and follows the links: each step appends the
siblings of one block and folds them into the hash it carries. Nodes with much below them are stored under
several salts, so that no key of that join meets more than KEY_LEAVES leaves.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import stored
from sedimenta.operators.numbering import numbered

FAN, HOP = 3, 4
WIDE = FAN**HOP
#: Leaves that meet one copy of a node in the recursive join.
KEY_LEAVES = FAN**8
#: The tree over the sources' roots; the others are numbered from 0.
TOP = -1


def digest(*values: Column) -> Column:
    """H of values: sha256, as bytes, of each as `-` if NULL, else its length in bytes, `:`, itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """`leaves`: one row a leaf, with its first block's siblings; `nodes`: all others; `subroots` by source; the `root` as hex text."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _runs(level: Column) -> Column:
    """The hashes of every FAN consecutive nodes, in hex text."""
    count = F.ceil(F.size(level) / F.lit(FAN)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.sha2(F.array_join(F.slice(level, j * FAN + 1, F.lit(FAN)), ""), 256))


def _siblings(level: Column, at: Column, up: int) -> Column:
    """The others of the run in which the ancestor of node `at`, `up` levels above it, stands."""
    place = F.floor(at / F.lit(FAN**up)).cast("int")
    start = F.floor(place / F.lit(FAN)).cast("int") * FAN
    before = F.array_join(F.slice(level, start + 1, place - start), "")
    after = F.array_join(F.slice(level, place + 2, start + FAN - 1 - place), "")
    return F.struct(F.unhex(before).alias("before"), F.unhex(after).alias("after"))


def _blocks(base: DataFrame, level: int, last_parent: bool) -> DataFrame:
    """The blocks over `(tree, idx, digest, total, cover, ...)`, stored: `(tree, block, total, cover, top, nodes, ...)`.

    `total` is the number of the tree's nodes on this level, `cover` the number of leaves below a node. The link
    of a block (`ptree, plevel, pidx`) is the node above it; a finished tree links to its place in the last tree, and
    the last tree, like the only source's, to nothing.
    """
    kept = [c for c in base.columns if c not in ("tree", "total")]
    block = F.floor(F.col("idx") / F.lit(WIDE)).alias("block")
    grouped = base.groupBy("tree", "total", block).agg(F.array_sort(F.collect_list(F.struct("idx", *[c for c in kept if c != "idx"]))).alias("held"))
    now = grouped.withColumn("level0", F.transform("held", lambda n: F.lower(F.hex(n["digest"]))))
    now = now.withColumnRenamed("total", "width")
    width = F.col("width")
    for up in range(HOP):
        remain = F.ceil(width / F.lit(FAN**up))  # nodes of the whole tree on that level
        now = now.withColumn(f"level{up + 1}", F.when(remain > 1, _runs(F.col(f"level{up}"))).otherwise(F.col(f"level{up}")))
    steps = lambda at: F.filter(
        F.array(*[F.when(F.ceil(width / F.lit(FAN**up)) > 1, _siblings(F.col(f"level{up}"), at, up)) for up in range(HOP)]), lambda s: s.isNotNull()
    )
    nodes = F.transform("held", lambda n, i: F.struct(*[n[c].alias(c) for c in kept], steps(i).alias("path")))
    rest = F.ceil(width / F.lit(WIDE)).cast("long")
    done = rest == 1
    nothing = F.lit(None).cast("long")
    parent = F.when(~done, F.col("tree")).when((F.col("tree") != TOP) & F.lit(not last_parent), F.lit(TOP).cast("long"))
    out = now.select(
        "tree",
        "block",
        rest.alias("total"),
        F.aggregate("held", F.lit(0).cast("long"), lambda a, n: a + n["cover"]).alias("cover"),
        F.unhex(F.element_at(f"level{HOP}", 1)).alias("top"),
        parent.alias("ptree"),
        F.when(parent.isNotNull(), F.when(done, 0).otherwise(level + HOP).cast("long")).alias("plevel"),
        F.when(parent.isNotNull(), F.when(done, F.col("tree")).otherwise(F.col("block"))).otherwise(nothing).alias("pidx"),
        nodes.alias("nodes"),
    )
    return stored(out, "blocks")


def _salts(cover: Column) -> Column:
    return F.greatest(F.ceil(cover / F.lit(KEY_LEAVES)), F.lit(1)).cast("long")


def _opened(blocks: DataFrame, level: int) -> DataFrame:
    """One row a node: its place, its link, the salts of the node linked to."""
    rows = blocks.select("tree", "ptree", "plevel", "pidx", _salts(F.col("cover")).alias("psalts"), F.explode("nodes").alias("n"))
    return rows.select("tree", F.lit(level).cast("long").alias("level"), "n.*", "ptree", "plevel", "pidx", "psalts")


def build(rows: DataFrame, order: list[Column], group: str) -> Manifest | None:
    """The manifest of `rows`, which have a binary column `digest`; leaves of a group ascend by `order`, NULL is a group.

    Groups are ordered as texts by bytes, NULL first. Rows equal in all of `order` may come in any order, so `order` should hold what
    the digests are made of. Further columns stay with the leaves. None if there are no rows.
    """
    placed = numbered(rows, order, [group], "idx", "leaves")
    sizes = stored(placed.groupBy(group).agg(F.count(F.lit(1)).alias("total")), "sources")
    trees = stored(numbered(sizes, [F.col(group).asc_nulls_first()], None, "tree", "trees").withColumnRenamed(group, "_group"), "trees")
    most, count = trees.agg(F.max("total"), F.count(F.lit(1))).first()
    if not count:
        return None
    base = placed.join(trees, placed[group].eqNullSafe(trees["_group"])).drop("_group", group).withColumn("cover", F.lit(1).cast("long"))
    built: list[tuple[int, DataFrame]] = []
    tops: list[DataFrame] = []

    def raise_levels(base: DataFrame, most: int) -> None:
        level = 0
        while True:
            blocks = _blocks(base, level, count == 1)
            built.append((level, blocks))
            above = blocks.select("tree", F.col("block").alias("idx"), F.col("top").alias("digest"), "total", "cover")
            tops.append(above.filter(F.col("total") == 1))
            most, level = -(-most // WIDE), level + HOP
            if most <= 1:
                return
            base = above.filter(F.col("total") > 1)

    raise_levels(base, most)
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    subroots = stored(subroots.select("tree", "digest", "cover"), "subroots")
    leaves, rest = _opened(built[0][1], 0), [_opened(b, level) for level, b in built[1:]]
    root = None
    if count > 1:
        built.clear(), tops.clear()
        raise_levels(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(count).cast("long").alias("total"), "cover"), count)
        rest += [_opened(b, level) for level, b in built]
        root = tops[-1].first()["digest"]
    else:
        root = subroots.first()["digest"]
    nodes = None
    for part in rest:
        part = part.select("tree", "level", "idx", "cover", "path", "ptree", "plevel", "pidx", "psalts")
        nodes = part if nodes is None else nodes.unionByName(part)
    if nodes is None:
        nodes = leaves.select("tree", "level", "idx", "cover", "path", "ptree", "plevel", "pidx", "psalts").filter(F.lit(False))
    named = subroots.join(trees.select("tree", F.col("_group").alias(group)), "tree").select("tree", group, F.col("digest").alias("subroot"))
    return Manifest(leaves, nodes, named, bytes(root).hex())


#: Folds siblings into a hash: each step hashes the run, with the carried hash in its place, as hex text.
_FOLD = "unhex(aggregate({path}, lower(hex({start})), (h, p) -> sha2(concat(lower(hex(p.before)), h, lower(hex(p.after))), 256)))"
_CLIMB = """
WITH RECURSIVE climb (tree, idx, hop, folded, siblings, ptree, plevel, pidx, psalt) AS (
    SELECT tree, idx, 0, {first}, path, ptree, plevel, pidx, pmod(xxhash64(tree, idx), psalts) FROM {leaves}
    UNION ALL
    SELECT c.tree, c.idx, c.hop + 1, {next}, n.path, n.ptree, n.plevel, n.pidx, pmod(xxhash64(c.tree, c.idx), n.psalts)
    FROM climb c JOIN {nodes} n ON c.ptree = n.tree AND c.plevel = n.level AND c.pidx = n.idx AND c.psalt = n.salt
)
SELECT tree, idx, hop, folded, siblings FROM climb LIMIT ALL
"""


def climb(manifest: Manifest, start: str = "digest") -> DataFrame:
    """`(tree, idx, proof_sha256, folded_root)`: each leaf's siblings up to the root, hashed together, and column `start` folded with them.

    One row per leaf. The siblings stay as they were built, so the folded hash equals the root if `start` is the leaf's digest.
    """
    spark = manifest.leaves.sparkSession
    names = {k: f"{k}_{uuid.uuid4().hex}" for k in ("leaves", "nodes")}
    salted = manifest.nodes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _salts(F.col("cover")) - 1))).drop("cover")
    manifest.leaves.createOrReplaceTempView(names["leaves"])
    salted.createOrReplaceTempView(names["nodes"])
    try:
        steps = spark.sql(_CLIMB.format(first=_FOLD.format(path="path", start=start), next=_FOLD.format(path="n.path", start="c.folded"), **names))
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
    way = steps.groupBy("tree", "idx").agg(F.array_sort(F.collect_list(F.struct("hop", "folded", "siblings"))).alias("way"))
    texts = F.transform(F.flatten(F.transform("way", lambda w: w["siblings"])), lambda p: F.concat(F.hex(p["before"]), F.hex(p["after"])))
    return way.select(
        "tree",
        "idx",
        F.sha2(F.lower(F.array_join(texts, "")), 256).alias("proof_sha256"),
        F.lower(F.hex(F.element_at("way", -1)["folded"])).alias("folded_root"),
    )


def audit(docs: DataFrame, identity: str = "doc_id", group: str = "source", fields: tuple[str, ...] = ("lang", "n_chars"), text: str = "text") -> DataFrame:
    """Builds the manifest of all rows, tampers with some texts and climbs: one row per input row.

    `(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`. A leaf is H of id, source, the fields and the text. Rows
    whose id as text has an even crc32 lose the line breaks of their text before the climb; rows without an id are
    not tampered with. Rows of one source ascend by id, NULL first, equal ids by their digests; repeated rows are
    leaves of their own, alike in every way but their place. NULL and empty texts differ (`-` and `0:`). Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[identity].dataType
    content, changed = F.col(text), F.replace(F.col(text), F.lit("\n"), F.lit(""))
    h = lambda t: digest(F.col(identity), F.col(group), *[F.col(f) for f in fields], t)
    hit = (F.crc32(F.col(identity).cast("string").cast("binary")) % 2 == 0) & F.contains(content, F.lit("\n"))
    rows = docs.select(
        F.col(identity).alias("id"),
        F.col(group).alias("source"),
        h(content).alias("digest"),
        F.when(hit, h(changed)).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),  # so that equal rows need not share one partition
    )
    manifest = build(rows, [F.col("id").asc_nulls_first(), F.col("digest").asc(), F.col("row").asc()], "source")
    if manifest is None:
        return spark.createDataFrame([], f"`{identity}` {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    manifest.leaves = manifest.leaves.withColumn("claimed", F.coalesce("tampered", "digest"))
    climbed = climb(manifest, "claimed")
    own = manifest.leaves.select("tree", "idx", F.col("id").alias(identity), F.lower(F.hex("digest")).alias("leaf"))
    subroots = manifest.subroots.select("tree", F.lower(F.hex("subroot")).alias("subroot"))
    rows = own.join(climbed, ["tree", "idx"]).join(subroots, "tree")
    return rows.select(identity, "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == manifest.root).alias("verified"))
