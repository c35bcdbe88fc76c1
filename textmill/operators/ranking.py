"""Exact ranks and running totals without one big window.

A window over a hot group would sort a third of all rows in one task. The helpers cut every group into many ordered
parts, number or sum inside the parts, and add the total of the earlier ones. The results equal those of the
plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.functions.numeric import fingerprint
from textmill.staging import stage


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; the keys of ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the order of the columns ``order``, nulls first, as column ``out``.

    Range partitions put the rows in order, the row counts of earlier partitions (one row a partition) give the offsets, and a
    row number inside each partition the rest. No task sees more than its own range; rows that tie in all columns get any of
    their positions. The ranges are written once, since their cut points come from a sample.
    """
    sorted_by = [F.col(f"`{c}`") for c in order]
    ranged = df.repartitionByRange(partitions, *sorted_by) if partitions else df.repartitionByRange(*sorted_by)
    parted = stage(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    placed = parted.withColumn("_r", F.row_number().over(W.partitionBy("_part").orderBy(*sorted_by)))
    return placed.join(offsets, "_part").select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_r") - 1).cast("bigint").alias(out))


def rank_within(
    df: DataFrame, key: str, groups: Sequence[str] = (), seed: str = "", out: str = "rank", digits: int = 3
) -> DataFrame:
    """1-based position of each row in its group, in the order of (md5 of the key, key).

    Equals ``row_number() over (partition by groups order by substr(md5(key), 1, 8), key)``. Buckets are the first
    ``digits`` hex digits of the hash, so even a group with a third of all rows is spread over 16**digits buckets. The
    offsets hold 16**digits rows per group; three digits keep them small enough to be broadcast for some dozens of groups.
    """
    groups = list(groups)
    hashed = df.withColumn("_h", fingerprint(F.col(key), seed)).withColumn("_b", F.substring("_h", 1, digits))
    sizes = hashed.groupBy(*groups, "_b").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*groups).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = W.partitionBy(*groups, "_b").orderBy("_h", key)
    ranked = hashed.withColumn("_r", F.row_number().over(inside))
    return (
        null_safe_join(ranked, offsets, [*groups, "_b"])
        .withColumn(out, (F.col("_off") + F.col("_r")).cast("bigint"))
        .select(*df.columns, out)
    )


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], groups: Sequence[str] = (), descending: bool = True, partitions: int | None = None
) -> DataFrame:
    """Running totals ``cum_<name>`` of the columns in ``sums`` by the order column, inside each group.

    ``df`` must hold one row per (groups, order) value. One range partitioning by (groups, order) sorts all groups at once: a group
    with crowded or very many values lies in as many partitions as it needs, small groups share one. The totals of the earlier
    partitions of a group, one row per (partition, group), are added to the running sums inside a partition. NaN ranks above all
    numbers.
    """
    groups = list(groups)
    direction = F.desc if descending else F.asc
    by = [*[F.asc(g) for g in groups], direction(order)]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    parted = stage(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    totals = parted.groupBy(*groups, "_part").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_part", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums])
    inside = W.partitionBy("_part", *groups).orderBy(direction(order)).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = parted.select(*df.columns, "_part", *[F.sum(s).over(inside).alias(f"_l_{s}") for s in sums])
    return null_safe_join(local, offsets, [*groups, "_part"]).select(
        *df.columns, *[(F.col(f"_o_{s}") + F.col(f"_l_{s}")).alias(f"cum_{s}") for s in sums]
    )
