"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but the last return the columns of ``docs``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import packing, simhash, surrogates, toxicity
from textmill.llm.common import table
from textmill.session import ship
from textmill.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity score does not reject, in the columns of ``docs``.

    Null and empty texts get the score of a text without words; repeated rows are judged alike. An empty table stays empty.
    """
    ship(spark)
    return toxicity.drop_toxic(spark, docs, sf_dir)


def without_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component (three-word shingles, at most two differing bits): the one with the smallest id.

    Null, empty and wordless texts share fingerprint zero, so one of them stays. Any other column is carried along,
    whatever its name.
    """
    ship(spark)
    return simhash.drop_duplicates(docs, "doc_id", "text")


def without_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates in place of personal data and secrets; null texts stay null."""
    ship(spark)
    return surrogates.hide_entities(spark, docs, sf_dir)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of at most 2048 tokens, with their ids; a null text has its end token only."""
    ship(spark)
    return packing.pack(docs, "doc_id", "text")


def stages() -> list[tuple[str, Stage]]:
    return [("toxicity", without_toxic), ("near_duplicates", without_duplicates), ("private_data", without_private), ("packing", packed)]


def run_stages(spark: SparkSession, sf_dir: str, todo: list[tuple[str, Stage]]) -> DataFrame:
    """The rows of the last stage; what earlier stages return is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, run) in enumerate(todo):
        docs = run(spark, docs, sf_dir)
        if i + 1 < len(todo):
            docs = stage(docs, f"corpus-{name}")
    return docs
