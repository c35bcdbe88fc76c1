"""SimHash near duplicates by a self-join of the binary trie of fingerprints.

1. A fingerprint per text: word shingles, XXH64, a bit is set where it is set in over half the hashes.
2. Equal fingerprints are merged before any join, so copies cost nothing below.
3. The distinct fingerprints are the leaves of a binary trie. Pairs of nodes of one depth are walked together from the
   root: differing bits add up, and a pair is dropped when they exceed the budget. The upper levels are walked as tables
   of node pairs, four bits a step, and only for nodes too large for one task; every pair of small nodes becomes one task
   that walks the rest of both subtries with arrays, in chunks of bounded size.
4. A task returns a spanning forest of the links that it has found, which has the same components as all of them and
   fewer rows than fingerprints. Components come from rounds of label exchange over written tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import map_batches, one_text, table
from textmill.staging import stage

SHINGLE_WORDS = 3
SEED = 42
MAX_DIFFERENT = 2
#: Fingerprints of both nodes together that one task may hold: 2 x 8 bytes each and the walk's chunks.
NODE_ROWS = 16_384
_STEP = 4
_CHUNK = 65_536
_ONE = np.uint64(1)


def fingerprint_of(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text; a text without words has fingerprint 0."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        grams = [b" ".join(tokens)]
    else:
        grams = map(b" ".join, zip(*[tokens[i:] for i in range(words)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 8192):
        rows = hashes[start : start + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, id_column: str, text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``id_column`` and ``fingerprint`` (the 64 bits as a signed long) of every row; a null text counts as empty."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = np.array([fingerprint_of(x, words, seed) for x in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.record_batch([batch.column(0), pa.array(marks.view(np.int64))], [id_column, "fingerprint"])

    chosen = df.select(F.col(id_column), one_text(text).alias("text"))
    return map_batches(chosen, step, f"`{id_column}` {chosen.schema[0].dataType.simpleString()}, fingerprint bigint")


# -- the trie ------------------------------------------------------------------------------------------------------------


def _prefix(mark: Column, depth: int) -> Column:
    """The first ``depth`` bits as a number."""
    return F.shiftrightunsigned(mark, 64 - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(marks: DataFrame, different: int, node_rows: int) -> DataFrame:
    """Pairs of nodes (depth, left_node <= right_node, used bits) that together hold every link and fit into one task.

    ``marks`` holds each fingerprint once. A table of node sizes is made for a depth only while there are pairs of nodes
    that are too large. At depth 64 a node is one fingerprint, so the loop ends.
    """
    spark = marks.sparkSession
    total = marks.count()
    ready = spark.createDataFrame([(0, 0, 0, 0)] if total <= node_rows else [], "depth int, left_node long, right_node long, used int")
    open_pairs = None if total <= node_rows else spark.createDataFrame([(0, 0, 0)], "left_node long, right_node long, used int")
    depth = 0
    while open_pairs is not None and depth < 64:
        depth += _STEP
        parent = F.shiftrightunsigned("node", _STEP)
        nodes = marks.groupBy(_prefix(F.col("fingerprint"), depth).alias("node")).agg(F.count("*").alias("rows"))
        if depth > _STEP:  # only the children of nodes that are still open
            wanted = open_pairs.select(F.explode(F.array("left_node", "right_node")).alias("__parent")).distinct()
            nodes = nodes.join(wanted, parent == F.col("__parent"), "left_semi")
        nodes = stage(nodes, "trie-nodes")
        left = nodes.select(parent.alias("left_node"), F.col("node").alias("a"), F.col("rows").alias("a_rows"))
        right = nodes.select(parent.alias("right_node"), F.col("node").alias("b"), F.col("rows").alias("b_rows"))
        grown = (
            open_pairs.join(left, "left_node").join(right, "right_node")
            .withColumn("used", (F.col("used") + F.bit_count(F.expr(f"(a ^ b) & {(1 << _STEP) - 1}"))).cast("int"))
            .where((F.col("used") <= different) & ((F.col("left_node") < F.col("right_node")) | (F.col("a") <= F.col("b"))))
        )
        small = (F.col("a_rows") + F.when(F.col("a") == F.col("b"), 0).otherwise(F.col("b_rows"))) <= node_rows
        grown = stage(
            grown.select(F.col("a").alias("left_node"), F.col("b").alias("right_node"), "used", (small | F.lit(depth == 64)).alias("small")),
            "trie-pairs",
        )
        done = grown.where("small").select(F.lit(depth).alias("depth"), "left_node", "right_node", "used")
        ready = ready.unionByName(done)
        open_pairs = grown.where("NOT small").drop("small")
        if open_pairs.isEmpty():
            open_pairs = None
    return ready


def _halves(marks: np.ndarray, low: np.ndarray, high: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where the bit turns from 0 to 1 in each sorted range [low, high) that agrees on all higher bits."""
    first = marks[low]
    border = ((first >> bit) | _ONE) << bit
    return np.clip(np.searchsorted(marks, border), low, high)


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, used: int, different: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two sorted arrays of distinct fingerprints (``right=None``: inside one), as pairs of positions.

    The frontier holds pairs of ranges. All ranges of a step lie at the same depth; a pair of single leaves is compared at
    once. The frontier is kept as a stack of chunks, so memory stays bounded.
    """
    own = right is None
    other = left if own else right
    if not len(left) or not len(other):
        return
    start = [np.array([x], dtype=np.int64) for x in (0, len(left), 0, len(other), used)]
    stack = [(depth, start)]
    while stack:
        at, (al, ah, bl, bh, err) = stack.pop()
        if len(al) > _CHUNK:
            stack += [(at, [x[i : i + _CHUNK] for x in (al, ah, bl, bh, err)]) for i in range(0, len(al), _CHUNK)]
            continue
        leaf = (ah - al == 1) & (bh - bl == 1)
        if leaf.any():
            i, j = al[leaf], bl[leaf]
            near = np.bitwise_count(left[i] ^ other[j]) <= different
            if own:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
        if not len(al) or at == 64:
            continue
        bit = np.uint64(63 - at)
        am, bm = _halves(left, al, ah, bit), _halves(other, bl, bh, bit)
        parts = []
        for a0, a1, b0, b1, extra in ((al, am, bl, bm, 0), (am, ah, bm, bh, 0), (al, am, bm, bh, 1), (am, ah, bl, bm, 1)):
            keep = (a0 < a1) & (b0 < b1) & (err + extra <= different)
            if own and extra:
                keep &= a0 < b0  # of the two mirrored pairs inside one trie, one
            parts.append([a0[keep], a1[keep], b0[keep], b1[keep], err[keep] + extra])
        merged = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if len(merged[0]):
            stack.append((at + 1, merged))


class _Forest:
    """Union-find that keeps the links which join two trees."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def forest_links(left: np.ndarray, right: np.ndarray | None, depth: int, used: int, different: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints at both ends of the links of a spanning forest."""
    other, shift = (left, 0) if right is None else (right, len(left))
    forest = _Forest(len(left) + (0 if right is None else len(right)))
    ends: tuple[list, list] = ([], [])
    for i, j in walk(left, right, depth, used, different):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if forest.link(a, b + shift):
                ends[0].append(a)
                ends[1].append(b)
    return left[ends[0]], other[ends[1]]


def _packed_nodes(marks: DataFrame, pairs: DataFrame, level: int) -> DataFrame:
    """``node``, ``marks``: the fingerprints of each node that is in a pair of this depth, at most ``node_rows``."""
    at = pairs.where(F.col("depth") == level)
    wanted = at.select(F.explode(F.array("left_node", "right_node")).alias("node")).distinct()
    inside = marks.select("fingerprint", _prefix(F.col("fingerprint"), level).alias("node")).join(wanted, "node", "left_semi")
    return inside.groupBy("node").agg(F.collect_list("fingerprint").alias("marks"))


def links(marks: DataFrame, different: int = MAX_DIFFERENT, node_rows: int = NODE_ROWS) -> DataFrame:
    """``a``, ``b``: links of distinct fingerprints that connect exactly what all links connect. ``marks``: distinct rows."""
    pairs = node_pairs(marks, different, node_rows)
    key = ["depth", "left_node", "right_node"]
    levels = pairs.agg(F.collect_set("depth").alias("levels")).first()["levels"]  # at most 17 numbers
    empty = marks.sparkSession.createDataFrame([], "a long, b long")
    if not levels:
        return empty
    nodes = None
    for level in levels:
        packed = _packed_nodes(marks, pairs, level).withColumn("depth", F.lit(level))
        nodes = packed if nodes is None else nodes.unionByName(packed)
    nodes = stage(nodes, "trie-leaves")
    sides = [
        wanted.join(nodes.withColumnRenamed("node", f"{side}_node"), ["depth", f"{side}_node"]).select(*key, "used", "marks", F.lit(side == "right").alias("right"))
        for side, wanted in (("left", pairs), ("right", pairs.where("left_node <> right_node")))
    ]

    def one_task(group: pa.Table) -> pa.Table:
        depth, used = group["depth"][0].as_py(), group["used"][0].as_py()
        held = {right.as_py(): np.sort(np.asarray(row.values).view(np.uint64)) for right, row in zip(group["right"], group["marks"], strict=True)}
        a, b = forest_links(held[False], held.get(True), depth, used, different)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return sides[0].unionByName(sides[1]).groupBy(*key).applyInArrow(one_task, "a long, b long")


# -- components ----------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` (a, b).

    Each round a node takes the smallest label among itself and its neighbours, and then the label of that label. Every
    round is written, so no lineage grows; the loop ends when a round changes nothing. Labels are gathered with a minimum,
    which is pre-aggregated, so a node with very many links is no hot group.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        after = lower.join(jump, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("new_root"), "root")
        written = stage(after, "labels")
        labels = written.select("node", F.col("new_root").alias("root"))
        if written.where("new_root <> root").isEmpty():
            return labels


def near_duplicates(df: DataFrame, id_column: str, text: str, different: int = MAX_DIFFERENT, node_rows: int = NODE_ROWS) -> DataFrame:
    """``id_column``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id of the component) of every row.

    Texts that are null, empty or without words have fingerprint zero and are linked like any other. Repeated rows and
    rows with equal ids appear as often as they come. A row whose id is null belongs to its component, but a null id is
    never the smallest one; a component of null ids only has component_id null. An empty table gives no rows.
    """
    marked = stage(fingerprints(df, id_column, text).withColumnRenamed(id_column, "id"), "fingerprints")
    marks = stage(marked.groupBy("fingerprint").agg(F.min("id").alias("smallest")), "distinct-fingerprints")
    roots = components(links(marks.select("fingerprint"), different, node_rows)).withColumnRenamed("node", "fingerprint")
    rooted = marks.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = stage(rooted.join(smallest, "root").select("fingerprint", "component_id"), "fingerprint-classes")
    text_of = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return marked.join(classes, "fingerprint").select(F.col("id").alias(id_column), text_of.alias("fingerprint"), "component_id")


def drop_duplicates(df: DataFrame, id_column: str, text: str, groups: Callable = near_duplicates, marks: Callable = fingerprints) -> DataFrame:
    """The rows of ``df``, one of each component of ``groups``: the one with the smallest id.

    Rows with a repeated id are judged each by its own component, and one of them stays where they agree; of rows without id,
    those stay whose component has no id at all, one of each fingerprint. Only ids of dropped rows are joined with the
    rows; texts move only if those are too many to be broadcast. Columns of ``df`` may have any names.
    """
    # a name that no column of df has, however it is written
    spare = "__" + "_".join(["dropped", *("x" for c in df.columns if c.lower().startswith("__dropped"))])
    key, gone = F.col(f"`{id_column}`"), f"{spare}_id"
    found = stage(groups(df, id_column, text).withColumnRenamed(id_column, gone), "duplicate-groups")
    again = stage(found.where(F.col(gone).isNotNull()).groupBy(gone).agg(F.count("*").alias("n")).where("n > 1").select(gone), "repeated-ids")
    dropped = stage(found.where(F.col(gone) != F.col("component_id")).join(again, gone, "left_anti").select(gone), "dropped-ids")
    kept = df.join(dropped, key == dropped[gone], "left_anti")
    if again.isEmpty() and found.where(F.col(gone).isNull()).isEmpty():
        return kept
    odd = kept.where(key.isNull()).unionByName(kept.join(again, key == again[gone], "left_semi"))
    whole = odd.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    marked = marks(whole, "row", "text").withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
    classes = found.select("fingerprint", "component_id").distinct()
    named = F.col("component_id").isNull() | (F.col(f"row.`{id_column}`") == F.col("component_id"))
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("#"), "fingerprint"))
    single = marked.join(classes, "fingerprint").where(named).withColumn("group", group).dropDuplicates(["group"])
    plain = kept.where(key.isNotNull()).join(again, key == again[gone], "left_anti")
    return plain.unionByName(single.select("row.*"))


def document_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), "doc_id", "text")
