"""Counts and distributions used to explore posts and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.tags import powerset_label
from textmill.operators.ranking import global_rank
from textmill.staging import scalar_of


def yearly_rate(df: DataFrame, ts: str, condition: Column, after: int, before: int) -> DataFrame:
    """(year, n, percent) per year with after < year < before: row count and percent meeting a condition, ordered.

    The year bound only looks at the grouping key, so Catalyst moves it below the aggregate to the scan.
    """
    per_year = df.groupBy(F.year(ts).alias("year")).agg(
        F.count("*").alias("n"),
        F.round(100 * F.sum(F.when(condition, 1).otherwise(0)) / F.count("*"), 1).alias("percent"),
    )
    return per_year.filter((F.col("year") > after) & (F.col("year") < before)).orderBy("year")


def tag_counts(df: DataFrame, tags: str = "tags") -> DataFrame:
    """(tag, n) over all posts."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def top_tags(counts: DataFrame, n: int = 50, tag: str = "tag", count: str = "n") -> DataFrame:
    """The n most used non-empty tags; ties in alphabetical order."""
    return counts.filter(F.col(tag) != "").orderBy(F.desc(count), tag).limit(n)


def keep_tags(df: DataFrame, nb_label: int, tags: str = "tags") -> DataFrame:
    """The first ``nb_label`` tags by frequency; asking for more than exist gives all of them."""
    return tag_counts(df, tags).orderBy(F.desc("n"), "tag").limit(nb_label)


def split_summary(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """(split, n, n_labels). Counting per (split, label) first keeps the distinct count free of hot keys."""
    per_label = df.groupBy(split, label).agg(F.count("*").alias("_n"))
    return per_label.groupBy(split).agg(F.sum("_n").alias("n"), F.count(label).alias("n_labels"))


def length_hist(df: DataFrame, col: str) -> DataFrame:
    """(length, n): exact distribution of a length column."""
    return df.groupBy(F.col(col).alias("length")).agg(F.count("*").alias("n"))


def equal_width_hist(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, n) with ``bins`` equal intervals between min and max; the last one is closed."""
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    bounds = scalar_of(values, F.struct(F.min("v").alias("low"), F.max("v").alias("high")))
    low, high = bounds.getField("low"), bounds.getField("high")
    raw = F.floor((F.col("v") - low) * bins / F.when(high > low, high - low).otherwise(F.lit(1.0)))
    counted = values.groupBy(F.least(raw, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    width = (high - low) / bins
    return counted.select("bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n")


def relative_frequency(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share): every row weighs 1/N."""
    counted = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.col("n") / scalar_of(counted, F.sum("n")))


def tagset_counts(df: DataFrame, tags: str = "tags", sep: str = " ") -> DataFrame:
    """(tagset, n): rows per full tag set."""
    return df.groupBy(powerset_label(F.col(tags), sep).alias("tagset")).agg(F.count("*").alias("n"))


def cooccurrence(df: DataFrame, tags: str = "tags") -> DataFrame:
    """(src, dst, weight) with src < dst: the posts that carry both tags, no self edges.

    Equal tag sets are counted first, so pairs are formed once per distinct tag set and not once per post.
    """
    sets = df.select(F.array_sort(F.array_distinct(tags)).alias("set")).groupBy("set").agg(F.count("*").alias("n"))
    sources = sets.select("set", "n", F.posexplode("set").alias("i", "src"))
    later = F.slice("set", F.col("i") + 2, F.greatest(F.array_size("set") - F.col("i") - 1, F.lit(0)))
    pairs = sources.select("src", F.explode(later).alias("dst"), "n")
    return pairs.groupBy("src", "dst").agg(F.sum("n").alias("weight"))


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with weight = N / (K * n_label)."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    mean = scalar_of(counted, F.sum("n") / F.count("*"))
    return counted.withColumn("weight", mean / F.col("n"))


def with_weights(df: DataFrame, weights: dict[str, float] | DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach a weight per label from a dict or from :func:`balanced_weights`."""
    if isinstance(weights, DataFrame):
        return df.join(weights.select(label, F.col("weight").alias(out)), label, "left")
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return df.withColumn(out, F.coalesce(F.try_element_at(table, F.col(label)), F.lit(1.0)))


def index_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_index): alphabetical position of each label, for encoding and decoding; null is no label.

    Labels are merged first and ranked by range partitions, so their number is not bounded by one task.
    """
    names = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    return global_rank(names, ["label"], "label_index").withColumn("label_index", F.col("label_index").cast("int"))


def with_ids(df: DataFrame, ids: Sequence[int] | DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is listed: a literal list is pushed to the scan, a table of ids becomes a semi-join."""
    return df.join(ids.select(key), key, "left_semi") if isinstance(ids, DataFrame) else df.filter(F.col(key).isin(list(ids)))


def in_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows with every listed column inside its closed range."""
    for name, (low, high) in ranges.items():
        df = df.filter(F.col(name).between(low, high))
    return df
