"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.staging import stage

#: Share of texts per Arrow batch; texts are long, so batches are cut by rows as well as by bytes.
TEXTS_PER_STEP = 256


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def usable_vector(vector: str, zero: bool = True) -> Column:
    """True for a vector that is not null and has only finite components; ``zero=False`` also rules out all-zero ones."""
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    if not zero:
        fine = fine & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def batches_of(batch: pa.RecordBatch, rows: int = TEXTS_PER_STEP) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch, so that Python objects are made for a few rows at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over slices of the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                yield fn(part)

    return df.mapInArrow(run, schema)


def one_text(text: str) -> Column:
    """The text as a string, null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


class Remembered(dict):
    """Computes missing values; keeps two generations of entries, so that its size is bounded."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


#: A key that holds more than this part of the rows is looked up by broadcast; there are fewer such keys than parts.
HOT_PARTS = 1024


def lookup(rows: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``values``, which has at most one row for each ``key``.

    Frequent keys, fewer than ``HOT_PARTS`` by the share that they must hold, are joined by broadcast; the rows of all other keys
    are joined as Catalyst likes, and no key of them is hot. ``rows`` is read three times, so it should be a written table.
    """
    uses = stage(rows.groupBy(key).agg(F.count("*").alias("uses")), "key-uses")
    hot = F.broadcast(uses.where(F.col("uses") * HOT_PARTS > uses.agg(F.sum("uses")).scalar()).select(key))
    often = F.broadcast(values.join(hot, key, "left_semi"))
    seldom = rows.join(hot, key, "left_anti").join(values, key)
    return rows.join(often, key).unionByName(seldom)
