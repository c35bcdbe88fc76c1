"""SparkSession settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="textmill-package-"), "textmill.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("textmill", os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def build_session(
    app_name: str = "textmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """Session with UTC time, ANSI arithmetic and adaptive execution.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster so that spark-submit decides; adaptive execution
    then coalesces small partitions, splits skewed joins and turns joins into broadcasts by measured size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no call-site capture per column expression: it slows down building wide plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    ship(spark)
    return spark
