"""All points of a search together, against one fit after the other and plain counts."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.errors import InvalidPoint
from textmill.operators import features, search, sweep
from textmill.operators.splits import kfold
from textmill.registered import QUERIES, load_all, searching

load_all()


def documents(spark, n=90):
    """Few words in many texts, empty texts, keys that repeat or are null, and rows without a label."""
    rng, rows = random.Random(4), []
    for i in range(n):
        label = rng.choice("abc")
        words = [rng.choice(["the", f"{label}{rng.randint(0, 6)}", f"w{rng.randint(0, 30)}", f"only{i}"]) for _ in range(rng.randint(0, 9))]
        key = None if i % 31 == 0 else i - 1 if i % 10 == 1 else i
        rows.append((key, None if i % 13 == 0 else label if i % 10 > 1 else "a", " ".join(words)))
    return spark.createDataFrame(rows, "id bigint, label string, text string")


def dealt(spark, docs, k):
    counts = features.count_packed(docs, "text", "id", ["label"], "space", apart=True)
    return sweep.fold_blocks(counts, kfold(docs.select("id", "label"), k, "id", "label"), 10_000)


POINTS = [
    {"alpha": 0.2}, {"alpha": 1.0, "norm": "l1"}, {"alpha": 0.5, "norm": "None", "min_df": 2}, {"min_df": 0.05, "max_df": 0.6}, {"min_df": 0.95, "max_df": 1.0},
    {"min_df": 0.6, "max_df": 0.5},
]


def test_points_together_are_as_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(sweep, "WIDE", 9)  # several readings of the blocks
    counts, blocks = dealt(spark, documents(spark), 3)
    study = searching.NaiveBayesStudy(blocks)
    found = study.together(counts, [(f, None, p) for p in POINTS for f in (0, 2)], "fold")
    assert isinstance(found[-1], InvalidPoint) and isinstance(found[-2], InvalidPoint)
    want = [study(counts.filter(F.col("fold") != f), counts.filter(F.col("fold") == f), p) for p in POINTS[:-1] for f in (0, 2)]
    assert found[:-2] == [pytest.approx(w) for w in want]


def test_curve_together_is_as_one_by_one(spark):
    """Small samples leave blocks without a row to learn from."""
    counts, blocks = dealt(spark, documents(spark).filter("id IS NOT NULL"), 2)
    study = searching.NaiveBayesStudy(blocks)
    sizes = (0.3, 0.6, 1.0)
    got, want = (search.learning_curve(counts, run, {"alpha": 1.0}, 2, sizes).orderBy("size").collect() for run in (study, lambda *a: study(*a)))
    assert [tuple(r) for r in got] == [pytest.approx(tuple(r)) for r in want]


def test_folded_counts_hold_every_document_once(spark):
    docs = documents(spark)
    counts, _ = dealt(spark, docs, 2)
    folds = sorted(kfold(docs.select("id", "label"), 2, "id", "label").collect(), key=str)
    assert sorted({(r.id, r.label, r.fold) for r in counts.collect()}, key=str) == sorted({tuple(r) for r in folds}, key=str)
    words = features.unpacked(counts).groupBy("id", "label", "term").agg(F.sum("tf").alias("n"))
    plain = docs.select("id", "label", F.explode(F.split("text", " ")).alias("term")).filter("term <> ''").groupBy("id", "label", "term").agg(F.count("*").alias("n"))
    assert sorted(map(str, words.collect())) == sorted(map(str, plain.collect()))


def test_many_points_move_the_documents_no_more_often(spark, sf, monkeypatch):
    """A search deals its documents out once, whatever the number of its points."""
    moved = []
    monkeypatch.setattr(sweep, "stage_buckets", lambda *a, plain=sweep.stage_buckets, **b: moved.append(1) or plain(*a, **b))
    monkeypatch.setattr(searching.bayes, "fit_nb", lambda *a, **b: pytest.fail("a fit of its own"))
    assert QUERIES["random_search"](spark, sf).count() == 2 and len(moved) == 1


def test_tune_runs_all_trials_of_the_source(spark, sf):
    rows = QUERIES["tune"](spark, sf).collect()
    assert len(rows) == 50 and {r.cv_folds for r in rows} == {5.0}
    assert all((r.test_score == 0.0) == (r.min_df > r.max_df) for r in rows) and sum(r.test_score > 0 for r in rows) == 28


def test_history_writes_no_text_and_its_batches_as_bytes(spark, sf, monkeypatch):
    """The text is counted where it lies, and the batches, which every share reads, are compressed."""
    from textmill.operators import bayes
    from textmill.registered import learning

    written = {}
    for module in (learning, bayes):
        monkeypatch.setattr(module, "stage", lambda df, name="stage", plain=module.stage: written.update({name: dict(df.dtypes)}) or plain(df, name))
    assert learning.batch_history(spark, sf).count() == 1
    assert not any("text" in columns for columns in written.values())
    assert {written["batch-cells"][c] for c in ("idx", "ends", "tf")} == {"binary"}


def test_ml_tfidf_cuts_the_text_once(spark, sf):
    plan = QUERIES["ml_tfidf"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "words#" in plan and "text#" not in plan
