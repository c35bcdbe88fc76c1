"""The cleaning projection on a stream. It keeps no state, so batch and stream give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textmill.plans.clean import clean_posts

RAW_POST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


def read_post_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New Parquet files of a post folder as a stream."""
    return spark.readStream.schema(RAW_POST).option("maxFilesPerTrigger", max_files).parquet(path)


def clean_post_stream(posts: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Clean posts as they arrive and append them to a Parquet table."""
    writer = clean_posts(posts).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
