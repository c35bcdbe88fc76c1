"""Reading tables and delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.ranking import rank_within

POST_COLUMNS = ("id", "title", "body", "tags")

CLEAN_POST = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("text_body", T.StringType(), True),
        T.StructField("code_body", T.StringType(), True),
        T.StructField("tags", T.ArrayType(T.StringType(), False), False),
    ]
)

TAG_TABLE = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("tag_name", T.StringType(), True),
        T.StructField("count", T.LongType(), True),
        T.StructField("excerpt_post_id", T.LongType(), True),
        T.StructField("wiki_post_id", T.LongType(), True),
    ]
)


def read_posts(spark: SparkSession, path: str, cols: Sequence[str] = POST_COLUMNS) -> DataFrame:
    """The named columns of a Parquet post table; the scan reads only those."""
    return spark.read.parquet(path).select(*cols)


def read_table(
    spark: SparkSession, path: str, cols: Sequence[str] | None = None, limit: int | None = None, order_by: str | None = None
) -> DataFrame:
    """Whole or projected table, optionally its first ``limit`` rows by a key, so that the choice is repeatable."""
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    if limit is None:
        return df
    return df.orderBy(order_by).limit(limit) if order_by else df.limit(limit)


def conform(df: DataFrame, schema: T.StructType = CLEAN_POST) -> DataFrame:
    """Cast to a declared schema. Null in a required field stops the job; a null repeated field becomes empty."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType.simpleString())
        if isinstance(field.dataType, T.ArrayType):
            value = F.coalesce(value, F.array().cast(field.dataType.simpleString()))
        elif not field.nullable:
            message = f"required field {field.name} is null"
            value = F.when(value.isNull(), F.raise_error(F.lit(message)).cast(field.dataType.simpleString())).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_text_lines(spark: SparkSession, path: str, names: Sequence[str], sep: str = ", ", header: bool = True) -> DataFrame:
    """Delimited text back to string columns; the last column keeps any further separators."""
    lines = spark.read.text(path)
    if header:
        lines = lines.filter(F.col("value") != sep.join(names))
    parts = F.split("value", sep.replace("|", "\\|"), len(names))
    return lines.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def to_batches(df: DataFrame, n: int, key: str, seed: str = "", partitions: int = 16) -> DataFrame:
    """Shuffled batches of ``n`` rows: a stable random order inside each of ``partitions`` hash partitions, cut every n.

    Adds ``part``, ``batch`` and ``slot``; every part ends with one batch that may be short. No global sort is done.
    """
    from textmill.functions.numeric import fingerprint_bucket

    parted = df.withColumn("part", fingerprint_bucket(F.col(key), partitions, seed).cast("int"))
    ranked = rank_within(parted, key=key, groups=["part"], seed=seed + "order")
    return ranked.select(
        *parted.columns,
        F.floor((F.col("rank") - 1) / n).cast("bigint").alias("batch"),
        ((F.col("rank") - 1) % n).cast("bigint").alias("slot"),
    )
