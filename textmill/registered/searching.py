"""Cross-validation and parameter search over the test tables, and the tables made from score logs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import functions as F

from textmill.operators import bayes, features, metrics, search, sweep
from textmill.operators.splits import kfold
from textmill.registered import register
from textmill.registered.learning import frame
from textmill.registered.reading import SCORES_SQL, score_log
from textmill.registered.tables import folded_words, rounded, table

NOW = datetime(2020, 1, 2, 3, 4)


def folded_counts(spark, sf, folds: int = 3):
    """Term counts of documents by language with a fold number, written once for all trials, and the study of naive Bayes on them."""
    docs = frame(spark, sf, "lang")
    counts = features.count_packed(docs, "text", "id", ["label"], folded_words, apart=True)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    folded, blocks = sweep.fold_blocks(counts, kfold(docs.select("id", "label"), folds, "id", "label"), size)
    return folded, NaiveBayesStudy(blocks)


@dataclass(frozen=True)
class NaiveBayesStudy:
    """Accuracy of naive Bayes on the test and the training fold, for one point or for all points of a search together."""

    blocks: int

    def __call__(self, train, test, params):
        train, test = train.drop("_block"), test.drop("_block")
        docs = train.select("id", "label").distinct()
        norm = params.get("norm", "l2")
        model = bayes.fit_nb(
            train, docs, alpha=params.get("alpha", 1.0), norm=None if norm == "None" else norm,
            min_df=params.get("min_df", 1), max_df=params.get("max_df", 1.0),
        )
        both = test.withColumn("side", F.lit("test")).unionByName(train.withColumn("side", F.lit("train")))
        scored = bayes.predict_nb(both, model, "id", ["label", "side"])
        rows = {r["side"]: r["accuracy"] for r in metrics.accuracy(scored, "label", "predicted", ["side"]).collect()}
        return rows["test"], rows["train"]

    def together(self, df, tasks, fold):
        return sweep.accuracies(df, self.blocks, tasks, fold=fold)


@register("grid_search")
def _(spark, sf):
    counts, study = folded_counts(spark, sf)
    summary, _ = search.grid_search(counts, {"alpha": [0.2, 1.0]}, study, folds=3)
    return rounded(summary.drop("date"))


@register("random_search")
def _(spark, sf):
    grid = {"alpha": [0.2, 0.4, 0.6, 0.8], "norm": ["l1", "l2", "None"]}
    counts, study = folded_counts(spark, sf, 2)
    summary, _ = search.random_search(counts, grid, study, n_iter=2, folds=2)
    return rounded(summary.drop("date"))


@register("tune")
def _(spark, sf):
    space = {"max_df": (0.0, 1.0), "min_df": (0.0, 1.0), "norm": ["l1", "l2", "None"], "alpha": (0.0, 1.0)}
    counts, study = folded_counts(spark, sf, 5)
    # 22 of the 50 draws have min_df above max_df: trials that score 0.0, not the end of the search
    summary, _ = search.tune(counts, space, study, trials=50, folds=5, max_failed=None)
    return rounded(summary.drop("date"))


@register("learning_curve")
def _(spark, sf):
    counts, study = folded_counts(spark, sf, 2)
    curve = search.learning_curve(counts, study, {"alpha": 1.0}, folds=2)
    return rounded(curve)


# ---- score tables ---------------------------------------------------------------------------------------------------

# lineitem rows as runs of a search: part of the order key as parameters, line numbers as folds
_RUNS = """
runs AS (SELECT l_orderkey % 50 AS depth, l_suppkey % 4 AS trees, l_linenumber AS fold, l_discount AS test_score, l_tax AS train_score,
  l_quantity AS fit_time FROM lineitem)"""


def runs(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("depth"), (F.col("l_suppkey") % 4).alias("trees"), F.col("l_linenumber").alias("fold"),
        F.col("l_discount").alias("test_score"), F.col("l_tax").alias("train_score"), F.col("l_quantity").alias("fit_time"),
    )


_SUMMARY = """
summary AS (SELECT avg(test_score) AS test_score, stddev_pop(test_score) AS std, avg(train_score) AS train_score, 5.0::DOUBLE AS cv_folds,
  depth, trees, '2020.01.02 03:04' AS date, 'words' AS vect FROM runs GROUP BY depth, trees)"""


@register(
    "cv_summary",
    f"""WITH {_RUNS}, {_SUMMARY} SELECT round(test_score, 6) AS test_score, round(std, 6) AS std, round(train_score, 6) AS train_score,
cv_folds, depth, trees, date, vect FROM summary""",
)
def _(spark, sf):
    return rounded(search.cv_summary(runs(spark, sf), ["depth", "trees"], 5, NOW, {"vect": "words"}))


@register(
    "warm_start",
    f"""
WITH s AS ({SCORES_SQL}), f AS (SELECT *, row_number() OVER (PARTITION BY max_depth ORDER BY run_id) AS r FROM s WHERE cv_folds = 4)
SELECT max_depth, round(test_score, 6) AS target FROM f WHERE r = 1 AND max_depth BETWEEN 2 AND 20
""",
)
def _(spark, sf):
    return rounded(search.warm_start(score_log(spark, sf), {"max_depth": (2, 20)}, 4))


@register(
    "progress_table",
    f"""WITH {_RUNS}, r AS (SELECT depth * 10 + trees AS run_id, * FROM runs)
SELECT run_id, round(avg(test_score), 6) AS mean_test_score, round(stddev_pop(test_score), 6) AS std_test_score,
  round(avg(fit_time), 6) AS mean_fit_time, depth, trees FROM r GROUP BY run_id, depth, trees""",
)
def _(spark, sf):
    numbered = runs(spark, sf).withColumn("run_id", F.col("depth") * 10 + F.col("trees"))
    return rounded(search.progress(numbered, ["depth", "trees"]))


@register(
    "param_slice",
    f"""WITH {_RUNS}, {_SUMMARY}
SELECT 'depth' AS param, CAST(depth AS VARCHAR) AS value, 'trees = ' || trees AS others, round(test_score, 6) AS test_score, round(std, 6) AS std FROM summary
UNION ALL SELECT 'trees', CAST(trees AS VARCHAR), 'depth = ' || depth, round(test_score, 6), round(std, 6) FROM summary""",
)
def _(spark, sf):
    summary = search.cv_summary(runs(spark, sf), ["depth", "trees"], 5, NOW)
    return rounded(search.param_slices(summary, ["depth", "trees"]))
