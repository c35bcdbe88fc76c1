"""Record functions: rows, outcomes, errors and set-ups."""

import functools
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.operators.records import BATCH_ROWS, map_records

# the workers cannot import this module, so its classes travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Repeat:
    """``n`` rows per input row; errors for negative ``n`` after one row, wrong types for ``n`` = 99."""

    def __init__(self, broken=False):
        self.broken = broken

    def setup(self):
        if self.broken:
            raise RuntimeError("no model")
        self.ready = True

    def process(self, row):
        assert self.ready
        if row["n"] is None:
            return
        if row["n"] < 0:
            yield {"x": 1}
            raise KeyError(row["n"])
        for i in range(row["n"]):
            yield {"x": "text" if row["n"] == 99 else i}


class Ticks:
    """A clock that moves 40 seconds with each look."""

    def __init__(self):
        self.now = 0

    def __call__(self):
        self.now += 40
        return self.now


def mapped(spark, rows, parts=3, **kw):
    return map_records(spark.createDataFrame(rows, "id int, n int, extra string").repartition(parts, "id"), Repeat, "x bigint, other string", **kw)


def test_rows_outcomes_and_errors(spark):
    done = mapped(spark, [(1, 2, "a"), (2, 0, None), (3, None, ""), (4, -5, "b"), (5, 99, "c"), (None, 1, "d"), (1, 2, "a")])
    records = sorted((r.id is None, r.id or 0, r.place, r.x, r.other) for r in done.records().collect())
    assert records == [(False, 1, 0, 0, None)] * 2 + [(False, 1, 1, 1, None)] * 2 + [(True, 0, 0, 0, None)]
    outcomes = done.outcomes().collect()
    assert sorted((r.id or 0, r.n, r.error is None) for r in outcomes) == [(0, 1, True), (1, 2, True), (1, 2, True), (2, 0, True), (3, 0, True), (4, 0, False), (5, 0, False)]
    errors = {r.id: r.error for r in done.failed().collect()}
    assert errors.keys() == {4, 5} and errors[4] == "KeyError: -5" and "Arrow" in errors[5]
    # one set-up for each partition that holds rows
    assert sum(r.setup_seconds is not None for r in outcomes) == len({r.partition for r in outcomes})
    assert all(r.cost == "TIME-OK" and r.seconds >= 0 for r in outcomes) and done.slow().count() == 0


def test_many_rows_empty_tables_and_names(spark):
    done = mapped(spark, [(1, 3 * BATCH_ROWS, ""), (2, 1, "")], 1)
    assert done.records().groupBy("id").count().orderBy("id").collect() == [(1, 3 * BATCH_ROWS), (2, 1)]
    assert done.records().filter(F.col("place") != F.col("x")).count() == 0
    empty = mapped(spark, [])
    assert empty.records().count() == empty.outcomes().count() == 0
    assert empty.records().columns == ["id", "place", "x", "other"]
    with pytest.raises(ValueError):
        map_records(spark.range(1), Repeat, "id int")


def test_slow_records_and_broken_set_up(spark):
    ticking = map_records(spark.createDataFrame([(1, 1)], "id int, n int"), Repeat, "x int", clock=Ticks())
    row = ticking.outcomes().first()
    assert (row.seconds, row.cost, row.setup_seconds) == (40.0, "TIME-OK", 40.0)
    slow = map_records(spark.createDataFrame([(1, 1)], "id int, n int"), Repeat, "x int", clock=lambda t=Ticks(): t() * 2)
    assert [r.cost for r in slow.slow().collect()] == ["TIME-ERROR1"]
    with pytest.raises(Exception, match="no model"):
        map_records(spark.createDataFrame([(1, 1)], "id int, n int"), functools.partial(Repeat, True), "x int")
