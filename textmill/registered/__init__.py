"""Named queries over the test tables, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL twin."""

    def keep(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return keep


def load_all() -> None:
    from textmill.registered import evaluation, exploring, learning, reading, searching, texts  # noqa: F401
