"""Writing tables, delimited text and JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_HEADER = ("id", "title", "text_body", "code_body", "tags")


def write_table(df: DataFrame, path: str, mode: str = "truncate") -> None:
    """Parquet table sink. 'truncate' replaces all rows, 'new' fails when the table exists, 'append' adds rows."""
    modes = {"truncate": "overwrite", "new": "errorifexists", "append": "append"}
    df.write.mode(modes[mode]).parquet(path)


def to_text_line(cols: Sequence[str] = TEXT_HEADER, tags: str = "tags") -> Column:
    """One line per record: fields joined by ', ', tags joined by '-', no quoting, null prints 'None'."""
    parts = []
    for name in cols:
        text = F.array_join(name, "-") if name == tags else F.coalesce(F.col(name).cast("string"), F.lit("None"))
        parts.append(text)
    return F.concat_ws(", ", *parts)


def to_text_lines(df: DataFrame, cols: Sequence[str] = TEXT_HEADER, tags: str = "tags") -> DataFrame:
    return df.select(to_text_line(cols, tags).alias("line"))


def write_text(df: DataFrame, path: str, cols: Sequence[str] = TEXT_HEADER, tags: str = "tags", mode: str = "overwrite") -> None:
    """Sharded text sink with the header line in every shard and '.csv' file names.

    Each record is one ready-made line; the quote and escape characters are switched off so that nothing is quoted.
    """
    header = ", ".join(cols)
    (
        df.select(to_text_line(cols, tags).alias(header))
        .write.mode(mode)
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("emptyValue", "")
        .csv(path)
    )


def to_json_records(df: DataFrame) -> DataFrame:
    """Every row as one JSON object, null fields kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def append_scores(scores: DataFrame, path: str) -> None:
    """Append a score table to a log; every run keeps its own columns, by name."""
    scores.write.mode("append").parquet(path)


def read_scores(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All runs of a score log, united by column name; columns that a run lacks are null."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", True).parquet(path)


def union_scores(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new score tables stacked by column name; columns that one of them lacks are null."""
    return old.unionByName(new, allowMissingColumns=True)
