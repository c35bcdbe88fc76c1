"""The cleaning job: post table -> clean posts -> table sink and text sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import lexicon
from textmill.functions.tags import intersect_tags
from textmill.functions.text import block_text, clean_text
from textmill.sources.readers import conform, read_posts
from textmill.sources.sinks import write_table, write_text


def clean_posts(posts: DataFrame, allowed: Sequence[str] = lexicon.ALLOWED_TAGS, html: bool = True) -> DataFrame:
    """(id, title, text_body, code_body, tags) from (id, title, body, tags): one projection, also valid on a stream.

    ``html=False`` takes the body as plain text without code.
    """
    body = F.col("body")
    text = block_text(body, "p") if html else F.coalesce(body, F.lit(""))
    code = block_text(body, "code") if html else F.lit("")
    return posts.select(
        "id",
        clean_text(F.col("title")).alias("title"),
        clean_text(text).alias("text_body"),
        clean_text(code).alias("code_body"),
        intersect_tags(F.col("tags"), allowed).alias("tags"),
    )


def preprocess(spark: SparkSession, source: str, table: str, text: str, partitions: int | None = None) -> DataFrame:
    """Run the whole job once and return the clean table.

    The text sink reads the table just written, so the cleaning itself runs only once. ``partitions`` spreads a source of
    few large files over more tasks before cleaning.
    """
    posts = read_posts(spark, source)
    if partitions:
        posts = posts.repartition(partitions)
    write_table(conform(clean_posts(posts)), table, "truncate")
    clean = spark.read.parquet(table)
    write_text(clean, text)
    return clean
