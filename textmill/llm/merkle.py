"""Merkle manifest of a table by a rollup of nested structs.

1. Every row becomes a leaf digest in the first scan; from then on only digests and the carried columns move.
2. Leaves get their rank in their group from range partitions and the row counts of earlier partitions, so a group of any
   size is ranked in many tasks.
3. The digits of the rank (base 16) are grouped away one after the other. A block of ``16 ** digits`` neighbouring leaves
   stays together; each grouping hashes the runs of 16 and nests the children in a struct of the run, so that a block
   ends as one row that holds its digest and, nested, everything below.
4. The digests of the blocks are the leaves of the next tier, which is rolled up in the same way, up to one digest a
   group; the digests of the groups are rolled up into the root.
5. Downwards, a transform over the nested structs gives each leaf the siblings of each level, and an explode emits them:
   no leaf is joined with anything. Only the path above a block comes by an equi-join of tiers, of one row a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import table
from textmill.staging import stage

FAN = 16
#: Levels of a block: 256 leaves are nested in one row.
DIGITS = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(fields: Sequence[Column]) -> Column:
    """Leaf digest: hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    written = []
    for field in fields:
        text = field.cast("string")
        written.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0, by ``order`` inside ``group``) and ``of`` (rows of the group); ``group`` is never null."""
    parted = stage(df.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = parted.groupBy("part", group).agg(F.count("*").alias("here"))
    before = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "part", group, F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"), F.sum("here").over(W.partitionBy(group)).alias("of")
    )
    inside = W.partitionBy("part", group).orderBy(*order)
    placed = parted.withColumn("place", F.row_number().over(inside)).join(offsets, ["part", group])
    return placed.select(*df.columns, (F.col("before") + F.col("place") - 1).alias("rank"), "of")


def roll_up(nodes: DataFrame, fan: int = FAN, digits: int = DIGITS) -> DataFrame:
    """One row a block of ``fan ** digits`` nodes: ``group``, ``rank`` (of the block), ``of`` (blocks of the group), ``digest``, ``kids``.

    ``nodes``: ``group``, ``rank``, ``of``, ``digest``, ``item`` (carried). ``kids`` holds the nodes in nested structs, one
    array a digit. A level is hashed while its group has more than one node there, so a lone node goes up as it is.
    """
    block = fan**digits
    level = nodes.select(
        "group", F.expr(f"rank div {block}").alias("block"), "of",
        *[F.expr(f"CAST(rank div {fan**i} % {fan} AS TINYINT)").alias(f"d{i}") for i in range(digits)], "digest", F.col("item").alias("kids"),
    )
    # one exchange by block serves all the groupings below
    level = level.repartition("group", "block")
    for i in range(digits):
        rest = [f"d{j}" for j in range(i + 1, digits)]
        child = F.struct(F.col(f"d{i}").alias("digit"), F.col("digest"), F.col("kids"))
        level = level.groupBy("group", "block", "of", *rest).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        hashed = F.sha2(_joined(F.col("kids.digest")), 256)
        level = level.select("group", "block", "of", *rest, F.when(F.col("of") > fan**i, hashed).otherwise(F.col("kids.digest")[0]).alias("digest"), "kids")
    return level.select("group", F.col("block").alias("rank"), F.expr(f"(of + {block - 1}) div {block}").alias("of"), F.col("of").alias("nodes"), "digest", "kids")


def _steps(kids: Column, above: Column, nodes: Column, level: int, fan: int) -> Column:
    """Array of (digest, path, item) of all nodes nested in ``kids``; ``above``: the path of ``kids`` themselves."""

    def one(kid: Column, at: Column) -> Column:
        digests = kids["digest"]
        side = F.struct(_joined(F.slice(digests, F.lit(1), at)).alias("left"), _joined(F.slice(digests, at + 2, F.lit(fan))).alias("right"))
        path = F.when(nodes > fan**level, F.concat(F.array(side), above)).otherwise(above)
        if level == 0:
            return F.struct(kid["digest"].alias("digest"), path.alias("path"), kid["kids"].alias("item"))
        return _steps(kid["kids"], path, nodes, level - 1, fan)

    found = F.transform(kids, one)
    return found if level == 0 else F.flatten(found)


def unroll(blocks: DataFrame, fan: int = FAN, digits: int = DIGITS) -> DataFrame:
    """The nodes of the blocks with their siblings: ``group``, ``digest``, ``path``, ``item``, and the columns ``top`` of the block.

    ``blocks``: rows of :func:`roll_up` with ``above``, the path of the block. A path is an array of (left, right), the
    joined digests of the siblings on both sides, from the leaf up.
    """
    found = _steps(F.col("kids"), F.col("above"), F.col("nodes"), digits - 1, fan)
    return blocks.select("group", "top", F.explode(found).alias("node")).select("group", "top", "node.*")


def fold(leaf: Column, path: Column) -> Column:
    """The digest that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def siblings_of(path: Column) -> Column:
    """All siblings of a path in one string, level by level from the leaf, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _tree(nodes: DataFrame, fan: int, digits: int) -> list[DataFrame]:
    """Tiers of written blocks, the lowest first; each group is one row in the last one."""
    tiers = []
    while True:
        blocks = stage(roll_up(nodes, fan, digits), "merkle-tier")
        tiers.append(blocks)
        if (blocks.agg(F.max("of").alias("of")).first()["of"] or 1) <= 1:
            return tiers
        nodes = blocks.select("group", "rank", "of", "digest", F.struct("rank").alias("item"))


def _paths(tiers: list[DataFrame], tops: DataFrame, fan: int, digits: int) -> DataFrame:
    """Nodes of the lowest tier with whole paths. ``tops``: ``group``, ``above``, ``top`` of every group."""
    at = tiers[-1].where("rank = 0").join(tops, "group")
    for lower in reversed(tiers[:-1]):
        paths = unroll(at, fan, digits).select("group", F.col("item.rank").alias("rank"), F.col("path").alias("above"), "top")
        at = lower.join(paths, ["group", "rank"])
    return unroll(at, fan, digits)


def manifest(df: DataFrame, group: str, order: Sequence[str], leaf: Column, carried: Sequence[str] = (), fan: int = FAN, digits: int = DIGITS) -> DataFrame:
    """``leaf``, ``subroot``, ``root``, ``path`` and the columns ``carried`` of every row of ``df``.

    Rows of one ``group`` (a string; null is a group of its own and comes first, the others in the order of their UTF-8
    bytes) are ordered by ``order``, nulls first, then by their leaf; equal rows swap places freely. Every ``fan`` nodes in
    a row become one until one is left, the subroot; the subroots become the root in the same way. ``path`` holds the
    siblings of each level up to the root: :func:`fold` leads from the leaf to the root. A null in any column is part of
    its leaf by the rule of ``leaf``. An empty table gives no rows, for there is no root of nothing. Columns of ``df`` may
    have any name, those of the result included.
    """
    name = F.col(f"`{group}`").cast("string")
    keys = [f"key{i}" for i in range(len(order))]
    leaves = df.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("group"),
        *[F.col(f"`{c}`").alias(key) for c, key in zip(order, keys, strict=True)], leaf.alias("digest"),
        F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in carried]).alias("item"),
    )
    tiers = _tree(ranked(leaves, "group", [*keys, "digest"]).select("group", "rank", "of", "digest", "item"), fan, digits)

    subroots = tiers[-1].select(F.lit("").alias("all"), F.col("group").alias("name"), "digest")
    upper = _tree(ranked(subroots, "all", ["name"]).select(F.col("all").alias("group"), "rank", "of", "digest", F.struct("name").alias("item")), fan, digits)
    root = upper[-1].select("group", F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)").alias("above"), F.struct(F.col("digest").alias("root")).alias("top"))
    groups = _paths(upper, root, fan, digits)
    tops = groups.select(
        F.col("item.name").alias("group"), F.col("path").alias("above"), F.struct(F.col("digest").alias("subroot"), F.col("top.root").alias("root")).alias("top")
    )
    rows = _paths(tiers, tops, fan, digits)
    return rows.select(*[F.col(f"item.`{c}`") for c in carried], F.col("digest").alias("leaf"), "top.subroot", "top.root", "path")


def document_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf, roots, digest of the proof and the outcome of tampering of every document; one without doc_id is not tampered with."""
    docs = table(spark, sf, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    altered = F.when(tampered, digest_of([*fields, F.translate("text", _UPPER, _LOWER)]))
    rows = docs.select("doc_id", "source", digest_of([*fields, F.col("text")]).alias("leaf"), altered.alias("altered"))
    found = manifest(rows, "source", ["doc_id"], F.col("leaf"), ["doc_id", "altered"])
    folded = found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings_of(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
