"""Rows of a projection stay in the blocks where they were written."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.operators import features, learners
from textmill.staging import bucket_of, stage_buckets


def test_buckets_are_grouped_without_a_move(spark):
    rows = stage_buckets(spark.range(100).selectExpr("cast(id % 7 as int) AS b", "id"), "b", 5)
    other = spark.range(7).selectExpr("cast(id as int) AS b", "10 * id AS x").repartition(5, "b")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.table({"b": right["b"], "n": pa.array([len(left)] * len(right), pa.int64())})

    met = rows.groupBy("b").cogroup(other.groupBy("b")).applyInArrow(run, "b int, n bigint")
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.b, r.n) for r in met.collect()} == {(i, 15 if i < 2 else 14) for i in range(7)}


def test_terms_with_one_entry_are_never_sent(spark, monkeypatch):
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((40, 12)) < 0.4, rng.random((40, 12)), 0.0)
    dense[:20, :3] += 1.5
    dense = np.hstack([dense, np.diag(rng.random(40))])
    keys = [None, *range(1, 40)]
    rows = [(keys[i], f"t{j:02d}", float(dense[i, j]) / 2) for i in range(40) for j in range(52) if dense[i, j] for _ in range(2 if j < 12 else 1)]
    dense[:, 12:] /= 2
    written = []
    monkeypatch.setattr(learners, "stage", lambda df, name, plain=learners.stage: written.append((name, plain(df, name))) or written[-1][1])
    found = learners.project_2d(spark.createDataFrame(rows, "id long, term string, value double"), tol=1e-7, max_rounds=200)
    images = [df for name, df in written if name == "images"]
    assert len(images) > 1 and all(r.term < "t12" for r in images[-1].collect())
    centred = dense - dense.mean(axis=0)
    _, sizes, axes = np.linalg.svd(centred, full_matrices=False)
    assert found.variances == pytest.approx((sizes[:2] ** 2 / 39).tolist())
    points = {r.id: (r.x, r.y) for r in found.points.collect()}
    components = {r.term: (r.x, r.y) for r in found.components.collect()}
    assert len(components) == 52
    for j, axis in enumerate(axes[:2]):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert [points[keys[i]][j] for i in range(40)] == pytest.approx((centred @ axis).tolist(), abs=1e-5)
        assert [components[f"t{t:02d}"][j] for t in range(52)] == pytest.approx(axis.tolist(), abs=1e-4)


def test_vectorising_moves_no_entry_of_a_document(spark, monkeypatch):
    monkeypatch.setattr(features, "OUT_ROWS", 3)
    rows = [(1, "a b a"), (1, "b c"), (None, "a a"), (2, None), (3, "c d"), (4, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    values = features.tfidf_vectorise(docs, "text", min_df=2, ngram_range=(1, 1))
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "tfs" in line] and "Window" not in plan
    counts = features.term_counts(features.explode_tokens(docs, "text"))
    plain = features.normalise(features.tfidf(counts, features.fit_vocab(counts, 2, n_docs=F.lit(6))))
    got = {(r.id, r.term): (r.tf, r.value) for r in values.collect()}
    assert got == {(r.id, r.term): (r.tf, pytest.approx(r.value)) for r in plain.collect()} and len(got) == 4


def test_every_block_has_a_bucket_of_its_own(spark):
    df = spark.range(1000)
    found = df.select(bucket_of(df, "id", 24).alias("b")).groupBy("b").agg(F.count("*").alias("n")).repartition(24, "b")
    assert found.rdd.glom().map(len).collect() == [1] * 24
