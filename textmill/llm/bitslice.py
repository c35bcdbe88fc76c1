"""Exact top-k inner products on a bit-sliced index.

Index: the quantised components of a block of rows, less the block's minimum per dimension, are stored as bitmaps, one
per dimension and bit, together with the sorted ids. Search: an inner product with a query is a weighted sum of those
bitmaps (a negative weight takes the complement), which full adders add up in bitmap arithmetic to the bit slices of all
scores of the block. The top rows are then selected from the most significant slice downward; rows that tie at the
boundary are resolved by smaller id. Every block returns at most k rows per query, which are merged per query.

Query blocks meet index blocks by their numbers: the query set is stated, and all rows are scored for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import table, usable_vector
from textmill.staging import stage

SCALE = 256
TOP = 5
#: Rows of an index block (64 dimensions of 9 bits: 1.2 MB) and queries of a query block (0.13 MB).
BLOCK_ROWS, QUERY_ROWS = 16_384, 256
_LIMIT = 2**31


def quantise(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of numbers, short rows filled with zeros; a component beyond 31 bits is refused, as scores could overflow."""
    flat = np.asarray(column.flatten(), dtype=np.int64)
    sizes = np.asarray(column.value_lengths(), dtype=np.int64)
    if len(flat) and max(int(flat.max()), -int(flat.min())) >= _LIMIT:
        raise ValueError("a quantised component has more than 31 bits")
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray] | None:
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    whole = pa.Table.from_batches(held).combine_chunks()
    ids, values = np.asarray(whole.column(0)), _matrix(whole.column(1).combine_chunks())
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order]


def build_index(df: DataFrame, id_column: str, vector: str, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Index blocks (block, rows, ids, low, bits, slices) of all usable rows; a repeated row is a row of its own.

    Vectors that are null or hold null or non-finite components, and rows without id, take no part.
    """
    usable = df.where(usable_vector(vector) & F.col(id_column).isNotNull())
    rows = usable.select(F.col(id_column).cast("bigint").alias("id"), quantise(vector, scale).alias("values"))
    blocks = max(1, -(-usable.select(F.lit(1)).count() * 10 // (9 * block_rows)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (got := _gathered(batches)) is None:
            return
        ids, values = got
        low = values.min(axis=0)
        above = values - low
        bits = [int(x).bit_length() for x in above.max(axis=0)]
        padded = np.zeros((-(-len(ids) // 64) * 64, values.shape[1]), dtype=np.int64)
        padded[: len(ids)] = above
        maps = [np.packbits((padded[:, d] >> j).astype(np.uint8) & 1, bitorder="little") for d, n in enumerate(bits) for j in range(n)]
        yield pa.record_batch(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(ids)], pa.int64()),
                pa.array([ids.tobytes()], pa.binary()), pa.array([low.tobytes()], pa.binary()),
                pa.array([np.array(bits, dtype=np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(m.tobytes() for m in maps)], pa.binary()),
            ],
            ["block", "rows", "ids", "low", "bits", "slices"],
        )

    schema = "block int, rows bigint, ids binary, low binary, bits binary, slices binary"
    return stage(rows.repartition(blocks).mapInArrow(build, schema), "bit-slices")


def pack_queries(df: DataFrame, id_column: str, vector: str, scale: int = SCALE, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Query blocks (part, width, ids, values). Of several rows with one id the smallest vector is the query."""
    usable = df.where(usable_vector(vector) & F.col(id_column).isNotNull())
    rows = usable.select(F.col(id_column).cast("bigint").alias("id"), quantise(vector, scale).alias("values"))
    single = rows.groupBy("id").agg(F.min("values").alias("values"))
    parts = max(1, -(-single.select("id").count() // query_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (got := _gathered(batches)) is None:
            return
        ids, values = got
        cells = [[TaskContext.get().partitionId()], [values.shape[1]], [ids.tobytes()], [values.tobytes()]]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["part", "width", "ids", "values"])

    return stage(single.repartition(parts).mapInArrow(build, "part int, width bigint, ids binary, values binary"), "queries")


class Block:
    """One index block, ready for searches."""

    def __init__(self, rows: int, ids: bytes, low: bytes, bits: bytes, slices: bytes):
        self.rows = rows
        self.ids, self.low, self.bits = (np.frombuffer(x, dtype=np.int64) for x in (ids, low, bits))
        words = -(-rows // 64)
        own = np.frombuffer(slices, dtype=np.uint64).reshape(int(self.bits.sum()), words)
        self.maps = np.concatenate([own, ~own])
        self.dim = np.repeat(np.arange(len(self.bits)), self.bits)
        self.level = np.concatenate([np.arange(n) for n in self.bits]) if len(self.dim) else np.zeros(0, dtype=np.int64)
        self.every = np.packbits(np.arange(words * 64) < rows, bitorder="little").view(np.uint64)

    def score_slices(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices of all scores less a constant, least significant first, and the constant."""
        size, negative = np.abs(weights), weights < 0
        constant = int((weights * self.low).sum()) - sum(int(s) * ((1 << int(n)) - 1) for s, n, neg in zip(size, self.bits, negative, strict=True) if neg)
        row = np.arange(len(self.dim)) + len(self.dim) * negative[self.dim]
        waiting: dict[int, list[np.ndarray]] = {}
        for shift in range(int(size.max(initial=0)).bit_length()):
            chosen = (size[self.dim] >> shift) & 1 == 1
            for level in np.unique(self.level[chosen]):
                waiting.setdefault(int(level) + shift, []).append(self.maps[row[chosen & (self.level == level)]])
        slices, level = [], 0
        while waiting:
            stack, carried = waiting.pop(level, []), waiting.get(level + 1, [])
            x = np.concatenate(stack) if stack else np.zeros((1, len(self.every)), dtype=np.uint64)
            while len(x) > 1:
                third = len(x) // 3
                if third:  # full adders
                    a, b, c = x[:third], x[third : 2 * third], x[2 * third : 3 * third]
                    half = a ^ b
                    carried.append((a & b) | (c & half))
                    x = np.concatenate([half ^ c, x[3 * third :]])
                else:  # a half adder
                    carried.append(x[:1] & x[1:])
                    x = x[:1] ^ x[1:]
            slices.append(x[0])
            if carried:
                waiting[level + 1] = carried
            level += 1
        return slices, constant

    def top(self, query_id: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Positions and scores of the k best rows, best first; ties go to the smaller id."""
        width = len(self.bits)
        fitted = np.zeros(width, dtype=np.int64)
        fitted[: min(width, len(weights))] = weights[:width]
        slices, constant = self.score_slices(fitted)
        tied = self.every.copy()
        for own in range(np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, side="right")):
            tied[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        sure = np.zeros_like(tied)
        for bits in reversed(slices):
            with_bit = tied & bits
            count = int(np.bitwise_count(sure | with_bit).sum())
            if count > k:
                tied = with_bit
            else:
                sure |= with_bit
                tied &= ~bits
        chosen = self._positions(sure)
        boundary = self._positions(tied)[: k - len(chosen)]  # equal scores; ids are sorted
        rows = np.concatenate([chosen, boundary])
        scores = [constant] * len(rows)
        for level, bits in enumerate(slices):
            on = (bits[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
            scores = [s + (int(b) << level) for s, b in zip(scores, on, strict=True)]
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], rows[i]))
        return rows[order], [scores[i] for i in order]

    @staticmethod
    def _positions(bits: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def search(index: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best rows of the index, without the query's own.

    Ties go to the smaller id. A query gets all rows if there are fewer than k, and none from an empty index.
    """
    index_blocks = [r[0] for r in index.select("block").collect()]  # numbers of blocks, one for 16,384 rows
    query_blocks = [r[0] for r in queries.select("part").collect()]
    if not index_blocks or not query_blocks:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, list, list] = ([], [], [])
        if len(left) and len(right):
            part, asked = left.iloc[0], right.iloc[0]
            block = Block(int(part["rows"]), part["ids"], part["low"], part["bits"], part["slices"])
            ids = np.frombuffer(asked["ids"], dtype=np.int64)
            values = np.frombuffer(asked["values"], dtype=np.int64).reshape(len(ids), int(asked["width"]))
            for query_id, weights in zip(ids.tolist(), values, strict=True):
                rows, scores = block.top(query_id, weights, k)
                out[0].extend([query_id] * len(rows))
                out[1].extend(block.ids[rows].tolist())
                out[2].extend(scores)
        return pd.DataFrame({n: pd.Series(x, dtype="int64") for n, x in zip(("query_id", "vec_id", "score"), out, strict=True)})

    left = index.withColumn("part", F.explode(F.lit(query_blocks).cast("array<int>")))
    right = queries.withColumn("block", F.explode(F.lit(index_blocks).cast("array<int>")))
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(one, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embedding_top(spark: SparkSession, sf: str, every: int = 50, k: int = TOP) -> DataFrame:
    """The k best rows for each row whose id is divisible by ``every``."""
    embeddings = table(spark, sf, "embeddings")
    asked = embeddings.where(F.col("vec_id") % every == 0)
    return search(build_index(embeddings, "vec_id", "embedding"), pack_queries(asked, "vec_id", "embedding"), k)


EMBEDDING_TOP_SQL = """
WITH usable AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
