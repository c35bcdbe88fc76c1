"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm.pipeline import run_stages, stages

STAGES = stages()
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, sf_dir, STAGES)
