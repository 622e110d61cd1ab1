"""A Merkle manifest of a dataset: a digest of every row, folded into one root.

Every row is a leaf. Leaves of one source, by document id, form a tree of runs of three; the roots
of the sources, by source, form another one above. Each row gets its leaf, the two roots and the
path of siblings that proves it.

How. Rows get their rank within the source (`ranked`: a range sort, then counts per range). The
rank's digits to the base 3 are columns. Rows meet in blocks of 3^DEPTH consecutive ranks, one
shuffle by (tree, block), and then one digit column after the other is grouped away: each group
nests its at most three child structs under their digest. These groupings refine the shuffle's
keys and need no further exchange. The digests of the blocks are the leaves of the same procedure
one storey higher, so a block never holds more than 3^DEPTH rows, whatever the size of a source.
On the way down the struct of a block is opened level by level with transform and explode, and
every child takes its siblings along: leaves meet their proofs without a join. Only blocks, one
row each, are joined with the path above them.

Results. Null fields are `-`. Rows without source form a tree of their own, the first one; rows
without doc_id come first in their tree and are never tampered with. Rows with equal doc_id lie by
their digest. A source with one row has that row's leaf as its subroot. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.llm.common import stored_table

FANOUT = 3
#: Levels of a block, which holds at most 3^7 = 2187 rows.
DEPTH = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


PATH = "array<struct<before: string, after: string>>"


def field_text(value: Column) -> Column:
    """`-` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path, from the leaf upwards, come to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Adds `rank` (from 0) of each row within its tree, and `size`, the rows of the tree.

    Rows are sorted by range, so a large tree lies in many ranges. Only the counts of (tree,
    range) are summed up along the ranges of a tree; a window over rows holds one range at most.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored_table(rows.repartitionByRange(tasks, tree, *order).withColumn("range", F.spark_partition_id()))
    counts = dealt.groupBy(F.col(tree).alias("t"), F.col("range").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    ranges = Window.partitionBy("t")
    before = ranges.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select("t", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(ranges).alias("size"))
    inside = F.row_number().over(Window.partitionBy(tree, "range").orderBy(*order))
    same = F.col(tree).eqNullSafe(F.col("t")) & (F.col("range") == F.col("r"))
    return (
        dealt.withColumn("inside", inside)
        .join(places, same)
        .select(*rows.columns, (F.col("before") + F.col("inside") - 1).cast("long").alias("rank"), "size")
    )


def _folds(level: int) -> Column:
    """Whether a tree of `size` leaves still has several nodes at a level."""
    return F.col("size") > FANOUT**level


def _rolled(rows: DataFrame) -> DataFrame:
    """Blocks (tree, block, size, hash, node) of rows (tree, rank, size, hash, node)."""
    digits = [f"d{level}" for level in reversed(range(DEPTH))]
    width = F.lit(FANOUT**DEPTH)
    places = [F.floor(F.col("rank") % width / FANOUT**level).cast("int") % FANOUT for level in reversed(range(DEPTH))]
    block = F.floor(F.col("rank") / width).cast("long")
    level_rows = rows.select(
        "tree", block.alias("block"), "size", *[p.alias(d) for p, d in zip(places, digits, strict=True)], "hash", "node"
    ).repartition("tree", "block")
    for level in range(DEPTH):
        last = digits.pop()
        keys = ["tree", "block", "size", *digits]
        kids = F.sort_array(F.collect_list(F.struct(last, "hash", "node")))
        below = F.col("kids.hash")
        level_rows = (
            level_rows.groupBy(*keys)
            .agg(kids.alias("kids"))
            .select(
                *keys,
                F.when(_folds(level), F.sha2(F.array_join(below, ""), 256)).otherwise(below[0]).alias("hash"),
                F.struct(F.transform("kids", lambda k: F.struct(k["hash"], k["node"])).alias("kids")).alias("node"),
            )
        )
    return level_rows


def _opened(blocks: DataFrame, above: Sequence[str]) -> DataFrame:
    """Rows (tree, block, place, hash, node, path, above...) of blocks with the path of their root."""
    rows = blocks.withColumn("place", F.lit(0).cast("long"))
    near = F.col("node.kids.hash")

    def child(kid: Column, at: Column) -> Column:
        return F.struct(
            at.alias("at"),
            kid["hash"].alias("hash"),
            kid["node"].alias("node"),
            F.array_join(F.slice(near, F.lit(1), at), "").alias("before"),
            F.array_join(F.slice(near, at + 2, F.lit(FANOUT)), "").alias("after"),
        )

    for level in reversed(range(DEPTH)):
        step = F.concat(F.array(F.struct("kid.before", "kid.after")), F.col("path"))
        rows = rows.withColumn("kid", F.explode(F.transform("node.kids", child))).select(
            "tree", "block", "size", *above,
            (F.col("place") * FANOUT + F.col("kid.at")).alias("place"),
            F.col("kid.hash").alias("hash"),
            F.col("kid.node").alias("node"),
            F.when(_folds(level), step).otherwise(F.col("path")).alias("path"),
        )
    return rows


def _proved(rows: DataFrame, roots_above: Callable[[DataFrame], DataFrame], above: Sequence[str]) -> DataFrame:
    """Rows (tree, rank, size, hash, node) with their path and the columns of roots_above.

    roots_above takes the roots (tree, hash) of all trees and gives (tree, path, above...).
    """
    blocks = stored_table(_rolled(rows))
    largest = blocks.agg(F.max("size")).first()[0] or 0
    if largest > FANOUT**DEPTH:
        storey = blocks.select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("size") / FANOUT**DEPTH).cast("long").alias("size"),
            "hash",
            F.struct(F.lit(0).alias("leaf")).alias("node"),
        )
        found = _proved(storey, roots_above, above).select("tree", (F.col("block") * FANOUT**DEPTH + F.col("place")).alias("block"), "path", *above)
    else:
        found = roots_above(blocks.select("tree", "hash")).select("tree", F.lit(0).cast("long").alias("block"), "path", *above)
    up = found.select(F.col("tree").alias("t"), F.col("block").alias("b"), "path", *above)
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b"))
    # Every block finds its path; a left join keeps the many blocks on the side that is streamed.
    return _opened(blocks.join(up, same, "left").drop("t", "b", "hash"), above)


def _one_root(roots: DataFrame) -> DataFrame:
    """The end of all paths."""
    return roots.select("tree", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))


def _over_sources(subroots: DataFrame) -> DataFrame:
    """Paths of the roots of the sources in the tree above them."""
    leaves = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "hash")
    rows = ranked(leaves, "tree", ["source"]).withColumn("node", F.struct("source"))
    proved = _proved(rows, _one_root, ["root"])
    return proved.select(F.col("node.source").alias("tree"), "path", F.col("hash").alias("subroot"), "root")


def manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """doc_id, source, leaf, subroot, root, path and the carried columns of every row.

    `carried` are further columns computed from the input rows. The path holds the digests
    before and after the row's own at each level, from the leaf to the root.
    """
    types = {"doc_id": "long", "n_chars": "long"}
    typed = docs.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in FIELDS])
    digest = row_digest([F.col(c) for c in FIELDS])
    leaves = stored_table(typed.select(F.col("source").alias("tree"), "doc_id", digest.alias("hash"), *[v.alias(k) for k, v in carried.items()]))
    kept = ["doc_id", *carried]
    rows = ranked(leaves, "tree", ["doc_id", "hash"]).withColumn("node", F.struct(*kept))
    proved = _proved(rows, _over_sources, ["subroot", "root"])
    return proved.select(
        "node.doc_id", F.col("tree").alias("source"), F.col("hash").alias("leaf"), "subroot", "root", "path", *[f"node.{k}" for k in carried]
    )


def tampered_digest() -> Column:
    """Digest of a row whose text lost its line ends where the check sum of the id is even; else null."""
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    return F.when(touched, row_digest([bare if c == "text" else F.col(c) for c in FIELDS]))


def verified(proofs: DataFrame) -> DataFrame:
    """Proofs of the manifest checked against the (partly tampered) digests in `tampered`."""
    again = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
