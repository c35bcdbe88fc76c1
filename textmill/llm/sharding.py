"""Contiguous shards of near-equal bytes by global prefix sums.

The rows are put into range partitions of one global order and written once. Each partition adds up its own bytes; the
totals (one row per partition) give every partition its offset, a running sum inside the partition gives every row its
place on the axis of all bytes, and the axis is cut at equal targets. A row belongs to the shard in which its middle
lies, so a shard misses its target by at most half a row at either end. Nothing but the partition totals is brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import one_text, table
from textmill.staging import stage


def shard_by_bytes(df: DataFrame, shards: int, size: Column, order: Sequence[Column]) -> DataFrame:
    """All columns of ``df`` plus ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0 inside the shard).

    ``size`` is the weight of a row, at least 1; a null or smaller weight counts as 1. ``order`` is the global order; rows
    that tie in it are put in any order, so equal rows may swap their slots. Rows that are repeated are rows of their own.
    An empty table gives no rows; with fewer rows than shards some shards are empty. Columns named ``shard`` and ``slot``
    are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    keys = [f"__order_{i}" for i in range(len(order))]
    sized = df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.greatest(F.coalesce(size.cast("bigint"), F.lit(1)), F.lit(1)).alias("__size"),
        *[column.alias(key) for column, key in zip(order, keys, strict=True)],
    )
    # the cut points of a range partitioning come from a sample, so the partition of each row is written down
    ranged = stage(sized.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), "shard-ranges")

    totals = ranged.groupBy("__part").agg(F.sum("__size").alias("__bytes"), F.count("*").alias("__rows"))
    every, before = W.partitionBy(), W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "__part",
        F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        F.sum("__bytes").over(every).alias("__all"),
    )
    inside = W.partitionBy("__part").orderBy(*keys)
    running = ranged.withColumns({
        "__end": F.sum("__size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)),
        "__row": F.row_number().over(inside),
    }).join(offsets, "__part")
    placed = running.select(
        *[F.col(f"`{c}`") for c in kept],
        F.expr(f"CAST((2 * (__bytes_before + __end) - __size) * {int(shards)} div (2 * __all) AS INT)").alias("shard"),
        (F.col("__rows_before") + F.col("__row") - 1).alias("__place"),
    )
    starts = placed.groupBy("shard").agg(F.min("__place").alias("__first"))
    slot = (F.col("__place") - F.col("__first")).cast("bigint")
    return placed.join(starts, "shard").select(*[F.col(f"`{c}`") for c in kept], "shard", slot.alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows of each shard in slot order under ``path/shard=N``.

    A shard may come as several files, whose slots are ranges; their order by name is the order of the slots.
    """
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(spark: SparkSession, sf: str, shards: int = 8) -> DataFrame:
    """Place of every document: law ``bytes``; equal texts are neighbours in the order (hash of the text, doc_id)."""
    text = one_text("text")
    documents = table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    placed = shard_by_bytes(documents, shards, F.col("size"), [F.col("text_hash"), F.col("doc_id")])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
