"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

Each table has a pseudo-random rotation: three rounds of random signs and the fast Hadamard transform. A unit vector
belongs to the signed axis nearest to its rotated image, so a table has two buckets per dimension. A query looks into the
buckets of its nearest axes in every table. All candidates are compared by exact Euclidean distance on the original
vectors. Equal vectors are searched as one; large buckets are cut into parts by hash, and every part returns at most k
vectors per query.

With 8 tables and 12 of 128 probes the ten nearest are found with a recall of 0.94 to 0.99 on 64 dimensions whose tenth
neighbour lies at a distance above 1.0; closer neighbours need fewer probes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import map_batches, table, usable_vector
from textmill.staging import stage

TABLES, PROBES, TOP, SEED = 8, 12, 10, 20_240_501
#: Vectors of one part of a bucket.
PART_ROWS = 4_096
#: A query meets at least so many vectors for each row that it returns.
LEAST_MET = 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def rotated(unit: np.ndarray, number: int, seed: int = SEED) -> np.ndarray:
    """Image of the rows under the rotation of table ``number``."""
    signs = np.random.default_rng([seed, number]).choice([-1.0, 1.0], size=(3, unit.shape[1]))
    for row in signs:
        unit = hadamard(unit * row)
    return unit


def padded_unit(vectors: list, width: int) -> np.ndarray:
    """Unit vectors, filled with zeros to ``width``."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    largest = np.abs(out).max(axis=1, keepdims=True)
    out /= np.where(largest > 0, largest, 1)  # first to a safe size, then to length 1
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def axes(unit: np.ndarray, number: int, probes: int, seed: int = SEED) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first; axis i + width is the negative of axis i."""
    image = rotated(unit, number, seed)
    both = np.concatenate([image, -image], axis=1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def hashed(df: DataFrame, width: int, tables: int, probes: int, seed: int) -> DataFrame:
    """(id, vector) plus ``axes``: per table the list of the nearest axes."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        unit = padded_unit(batch.column(1).to_pylist(), width)
        found = np.stack([axes(unit, t, probes, seed) for t in range(tables)], axis=1) if len(unit) else np.zeros((0, tables, probes), dtype=int)
        return pa.record_batch([*batch.columns, pa.array(found.tolist(), pa.list_(pa.list_(pa.int32())))], [*batch.schema.names, "axes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_batches(df, step, f"{fields}, axes array<array<int>>")


def nearest(
    rows: DataFrame, queries: DataFrame, id_column: str, vector: str, k: int = TOP, tables: int = TABLES, probes: int = PROBES,
    seed: int = SEED, part_rows: int = PART_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (distance): the k nearest rows found, without the query's own.

    Rows without id and vectors that are null, zero or hold null or non-finite components take no part; a shorter vector
    counts as filled with zeros. Ties go to the smaller id. Rows repeated with id and vector count once; of several query rows
    with one id the smallest vector is the query. A query whose probes in the first table meet fewer than ``LEAST_MET * k``
    vectors probes all axes of that table, which hold every vector once, so it gets the exact k nearest, or all where there
    are fewer. Every other query meets enough vectors for k rows.
    """
    double = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))  # turns -0.0 into 0.0
    usable = usable_vector(vector, zero=False) & F.col(id_column).isNotNull()
    chosen = rows.where(usable).select(F.col(id_column).cast("bigint").alias("id"), double.alias("vector")).distinct()
    asked = queries.where(usable).select(F.col(id_column).cast("bigint").alias("id"), double.alias("vector")).groupBy("id").agg(F.min("vector").alias("vector"))
    longest = chosen.agg(F.max(F.size("vector"))).first()[0]
    asked_longest = asked.agg(F.max(F.size("vector"))).first()[0]
    if not longest or not asked_longest:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = max(longest, asked_longest)
    width = 1 << (dims - 1).bit_length()
    probes = min(probes, 2 * width)

    # of equal vectors only the k + 1 smallest ids can be among the k nearest of any query
    first = W.partitionBy("vector").orderBy("id")
    classes = chosen.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    distinct = classes.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    members = stage(hashed(distinct.select("ids", "vector"), width, tables, 1, seed), "hashed-vectors")
    in_tables = members.select("ids", "vector", F.posexplode("axes").alias("table", "axis")).withColumn("axis", F.element_at("axis", 1))
    # one row per table and axis
    parts = in_tables.groupBy("table", "axis").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"), F.count("*").alias("rows"))
    sizes = F.broadcast(parts)
    spread = in_tables.join(sizes, ["table", "axis"]).withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int"))
    near = hashed(asked, width, tables, probes, seed).select("id", "vector", F.posexplode("axes").alias("table", "near"))
    probed = stage(near.select("id", "vector", "table", F.explode("near").alias("axis")).join(sizes, ["table", "axis"]), "probes")
    met = probed.where("table = 0").groupBy("id").agg(F.sum("rows").alias("met"))
    short = asked.join(met, "id", "left").where(F.coalesce("met", F.lit(0)) < LEAST_MET * k).select("id", "vector")
    short = short.select("id", "vector", F.lit(0).alias("table"), F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))).alias("axis")).join(sizes, ["table", "axis"])
    # an axis that a short query has probed already is probed once
    probed = probed.unionByName(short).groupBy("id", "table", "axis").agg(F.any_value("vector").alias("vector"), F.max("parts").alias("parts"))
    probed = probed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["table", "axis", "part"]

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, list, list] = ([], [], [])
        if len(left) and len(right):
            matrix = np.zeros((len(right), dims))
            for i, v in enumerate(right["vector"]):
                matrix[i, : len(v)] = v
            ids = [np.asarray(x, dtype=np.int64) for x in right["ids"]]
            smallest = np.array([x[0] for x in ids])
            for query_id, v in zip(left["id"].tolist(), left["vector"], strict=True):
                point = np.zeros(dims)
                point[: len(v)] = v
                distance = np.sqrt(np.square(matrix - point).sum(axis=1))
                taken = min(len(distance), k + 1)
                limit = np.partition(distance, taken - 1)[taken - 1]
                near = np.flatnonzero(distance <= limit)
                near = near[np.lexsort((smallest[near], distance[near]))]
                pairs = [(distance[j], i) for j in near for i in ids[j].tolist() if i != query_id]
                for d, i in sorted(pairs)[:k]:
                    out[0].append(query_id)
                    out[1].append(i)
                    out[2].append(float(d))
        return pd.DataFrame({"query_id": pd.Series(out[0], dtype="int64"), "vec_id": pd.Series(out[1], dtype="int64"), "score": pd.Series(out[2], dtype="float64")})

    found = probed.groupBy(*key).cogroup(spread.select("ids", "vector", *key).groupBy(*key)).applyInPandas(one, "query_id long, vec_id long, score double")
    return _best(found, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of the candidates of all tables; a vector found in several tables counts once."""
    near = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embedding_neighbours(spark: SparkSession, sf: str, every: int = 100, k: int = TOP) -> DataFrame:
    """The k nearest found for each row whose id is divisible by ``every``."""
    embeddings = table(spark, sf, "embeddings")
    return nearest(embeddings, embeddings.where(F.col("vec_id") % every == 0), "vec_id", "embedding", k)
