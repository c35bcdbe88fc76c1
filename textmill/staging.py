"""Tables written between the stages of a job.

A frame that several later branches read (term counts, folds, probabilities) is written once as Parquet into the
shared folder named by ``spark.checkpoint.dir`` and read back. That cuts the lineage, survives the loss of executors,
keeps column pruning for every reader, and gives the optimizer the true size of the data, so a join is turned into a
broadcast only when the measured bytes are under ``spark.sql.autoBroadcastJoinThreshold``.

All tables of one application lie in one folder, so the whole folder can be dropped when the application has ended.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a partition that :func:`spread` makes.
SPREAD_ROWS = 20_000
_UNSET_ROOTS: dict[str, str | None] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder of the cluster; a temporary folder only where the session names none (tests, laptops)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _UNSET_ROOTS.setdefault(app, None) or tempfile.mkdtemp(prefix="textmill-checkpoint-")
        _UNSET_ROOTS[app] = root
    return root.rstrip("/")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads the written table."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/textmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, column: str, n: int, name: str = "buckets", dealt: bool = False) -> DataFrame:
    """Write ``df`` once as ``n`` buckets by a column; what is grouped by this column in ``n`` partitions reads them where they lie.

    ``dealt``: the rows of ``df`` already lie in ``n`` partitions by this column and are not moved again. The table has a name only until its frame is made; the files stay with the other tables of the application.
    """
    spark, table = df.sparkSession, f"textmill_{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/textmill/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    (df if dealt else df.repartition(n, column)).write.format("parquet").bucketBy(n, column).option("path", path).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return found


def bucket_of(df: DataFrame, key: str, n: int) -> F.Column:
    """Block of a key out of ``n``, numbered so that hash partitioning by this number deals every block to a bucket of its own."""
    numbers = df.sparkSession.range(30 * n).select(F.col("id").cast("int").alias("v"))
    own = [r[0] for r in numbers.groupBy(F.pmod(F.hash("v"), F.lit(n))).agg(F.min("v").alias("v")).select("v").orderBy("v").collect()]
    return F.get(F.expr(f"array({', '.join(map(str, own))})"), F.pmod(F.xxhash64(key), F.lit(len(own))).cast("int"))


def scalar_of(df: DataFrame, expr: str | F.Column):
    """One aggregate over ``df`` as a scalar subquery, usable inside any expression of another frame."""
    column = F.expr(expr) if isinstance(expr, str) else expr
    return df.agg(column.alias("value")).scalar()


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """Rows over at least ``least`` partitions (as many as there are task slots), and over more where one would get over ``SPREAD_ROWS`` rows."""
    parts = max(least or df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df
