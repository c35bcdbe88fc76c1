"""Repeatable samples, train/eval splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.numeric import fingerprint_bucket
from textmill.operators.ranking import null_safe_join, rank_within


def sample(df: DataFrame, frac: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample; a fraction outside (0, 1) means no sampling."""
    return df.sample(False, frac, seed) if 0 < frac < 1 else df


def hash_sample(df: DataFrame, frac: float, key: str, seed: str = "sample") -> DataFrame:
    """Repeatable sample by key; a fraction outside (0, 1) means no sampling."""
    if not 0 < frac < 1:
        return df
    return df.filter(fingerprint_bucket(F.col(key), 10000, seed) < round(frac * 10000))


def with_split(df: DataFrame, key: str, eval_pct: float = 20, out: str = "split", seed: str = "") -> DataFrame:
    """Add 'eval' for buckets below ``eval_pct`` (0..100) and 'train' for the rest."""
    bucket = fingerprint_bucket(F.col(key), 100, seed)
    return df.withColumn(out, F.when(bucket < eval_pct, "eval").otherwise("train"))


def hash_split(df: DataFrame, key: str, eval_pct: float = 20) -> tuple[DataFrame, DataFrame]:
    """(train, eval): disjoint, exhaustive and the same on every run."""
    bucket = fingerprint_bucket(F.col(key), 100)
    return df.filter(bucket >= eval_pct), df.filter(bucket < eval_pct)


def random_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 30, out: str = "split") -> DataFrame:
    """Unstratified split by a seeded hash with a resolution of 1/10000."""
    bucket = fingerprint_bucket(F.col(key), 10000, str(seed))
    return df.withColumn(out, F.when(bucket < round(test_share * 10000), "eval").otherwise("train"))


def _label_ranks(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    ranked = rank_within(df, key=key, groups=[label], seed=str(seed), out="_rank")
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    return null_safe_join(ranked, sizes, [label])


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 30, out: str = "split"
) -> DataFrame:
    """Split that keeps the share of every label: the first round(share * n_label) rows in hash order are 'eval'."""
    held_out = F.col("_rank") <= F.round(F.col("_size") * test_share)
    return _label_ranks(df, label, key, seed).select(*df.columns, F.when(held_out, "eval").otherwise("train").alias(out))


def kfold(df: DataFrame, k: int, key: str, label: str | None = None, seed: int = 30, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1. With a label the folds are stratified: ranks inside the label modulo k."""
    if label is None:
        return df.withColumn(out, fingerprint_bucket(F.col(key), k, str(seed)).cast("int"))
    ranked = rank_within(df, key=key, groups=[label], seed=str(seed), out="_rank")
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias(out))


def dedupe(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """First row per key combination in the order of ``order_by``.

    ``min_by`` over the whole row pre-aggregates before the shuffle, so a hot key never lands in one task as raw rows.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col(order_by)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


