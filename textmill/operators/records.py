"""Python functions from one record to any number of records, for what built-in expressions cannot say.

A function is an object with ``setup()``, called once per partition before its first record (load a model, open a client), and
``process(row)``, which yields the output rows of one input row as dicts. What happens to every record is data too: how long
it took, how many rows it gave, and the error that ended it. A failing record gives no output rows and does not end the job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.types import _parse_datatype_string as parse_schema

from textmill.functions.numeric import cost_class
from textmill.staging import stage

# output rows that a task holds before it hands them on
BATCH_ROWS = 1_000
RECORD, OUTCOME = "record", "outcome"


class RecordFunction(Protocol):
    def setup(self) -> None: ...

    def process(self, row: dict[str, Any]) -> Iterable[dict[str, Any]]: ...


@dataclass
class Mapped:
    """Written result of a record function."""

    table: DataFrame
    key: str
    fields: list[str]

    def records(self) -> DataFrame:
        """(key, place, output columns...): the output rows; ``place`` counts from 0 within an input row."""
        return self.table.filter(F.col("_kind") == RECORD).select(self.key, F.col("_place").alias("place"), *[f"_out.{f}" for f in self.fields])

    def outcomes(self) -> DataFrame:
        """(key, n, seconds, cost, error, partition, setup_seconds): one row per input row.

        ``error`` is null where all went well. ``setup_seconds`` stands on the first row of each set-up only.
        """
        rows = self.table.filter(F.col("_kind") == OUTCOME)
        return rows.select(
            self.key, F.col("_place").alias("n"), F.col("_seconds").alias("seconds"), cost_class(F.col("_seconds")).alias("cost"),
            F.col("_error").alias("error"), F.col("_partition").alias("partition"), F.col("_setup").alias("setup_seconds"),
        )

    def failed(self) -> DataFrame:
        return self.outcomes().filter(F.col("error").isNotNull())

    def slow(self) -> DataFrame:
        """Outcomes of the records that took a minute or longer."""
        return self.outcomes().filter(F.col("cost") != "TIME-OK")


def map_records(
    df: DataFrame, make: Callable[[], RecordFunction], schema: str, key: str = "id", clock: Callable[[], float] = time.perf_counter
) -> Mapped:
    """Run a record function over every row of ``df``, once, and write output rows and outcomes to one table.

    ``make`` builds the function in the worker and ``schema`` (DDL) names its output columns; missing ones are null. The table
    is written before it is read, so records and outcomes belong to the same run and a view on either does not run the
    function again. The output of one input row is held until that row has ended, so a row that fails half-way leaves
    nothing behind; a task holds no more than that and ``BATCH_ROWS`` rows. Errors of ``setup`` end the job, as no record could be
    processed. Null cells arrive as None; an empty partition runs no set-up.
    """
    out = parse_schema(schema)
    taken = {key, "place"} & set(out.names)
    if taken:
        raise ValueError(f"output columns may not be called {sorted(taken)}")
    shape = StructType(
        [
            StructField(key, df.schema[key].dataType),
            StructField("_kind", StringType()),
            StructField("_place", LongType()),
            StructField("_out", out),
            *[StructField(name, kind) for name, kind in (("_seconds", parse_schema("double")), ("_error", StringType()), ("_partition", LongType()), ("_setup", parse_schema("double")))],
        ]
    )
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        arrow = to_arrow_schema(shape)
        partition = TaskContext.get().partitionId()
        function, setup_seconds, held = None, None, []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(held, schema=arrow)
            held.clear()
            return batch

        for batch in batches:
            # a slice at a time: the cells of a whole batch of long texts are never all Python objects
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if function is None:
                    begin = clock()
                    function = make()
                    function.setup()
                    setup_seconds = clock() - begin
                begin, error, given = clock(), None, []
                try:
                    for record in function.process(row):
                        # types are checked here, so that a wrong value is an error of this record
                        given.append(record)
                    if given:
                        pa.array([{n: g.get(n) for n in names} for g in given], arrow.field("_out").type)
                except Exception as exc:  # noqa: BLE001 - any error of a record is a row of the result
                    error, given = f"{type(exc).__name__}: {exc}", []
                spent = clock() - begin
                held += [
                    {key: row[key], "_kind": RECORD, "_place": i, "_out": {n: g.get(n) for n in names}} for i, g in enumerate(given)
                ]
                held.append(
                    {
                        key: row[key], "_kind": OUTCOME, "_place": len(given), "_seconds": spent, "_error": error,
                        "_partition": partition, "_setup": setup_seconds,
                    }
                )
                setup_seconds = None
                if len(held) >= BATCH_ROWS:
                    yield flush()
        if held:
            yield flush()

    return Mapped(stage(df.mapInArrow(run, shape), "records"), key, names)
