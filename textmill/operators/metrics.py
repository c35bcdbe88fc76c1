"""Scores of predictions. All are aggregates; only class-by-class tables and metric rows leave the cluster.

Prediction frames have the columns ``truth`` and ``predicted`` unless other names are given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.operators.ranking import running_totals
from textmill.staging import scalar_of, stage

CLIP = 1e-15


def share(condition: Column) -> Column:
    """Share of rows that satisfy a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


# ---- confusion and what follows from it -----------------------------------------------------------------------------


def confusion(pred: DataFrame, truth: str = "truth", predicted: str = "predicted", normalize: bool = False) -> DataFrame:
    """(truth, predicted, n), with ``share`` of the true label when normalised."""
    cm = pred.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    if normalize:
        return cm.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("truth")))
    return cm


def label_marginals(cm: DataFrame) -> DataFrame:
    """(side, label, n): row sums ('actual') and column sums ('predicted') of a confusion table."""
    actual = cm.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("n")).withColumn("side", F.lit("actual"))
    guessed = cm.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("n")).withColumn("side", F.lit("predicted"))
    return actual.unionByName(guessed)


def per_label(cm: DataFrame) -> DataFrame:
    """(label, tp, support, guessed) for every label that occurs as truth or prediction; one pass over the confusion rows."""
    sides = F.explode(
        F.array(
            F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed")),
            F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed")),
        )
    ).alias("s")
    hit = F.when((F.col("truth") == F.col("predicted")) & (F.col("s.support") > 0), F.col("n")).otherwise(0)
    flat = cm.select("truth", "predicted", "n", sides).select("s.label", "s.support", "s.guessed", hit.alias("tp"))
    return flat.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("guessed").alias("guessed"))


def label_scores(cm: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support); undefined values are 0."""
    zero = F.lit(0.0)
    return per_label(cm).select(
        "label",
        F.coalesce(F.try_divide("tp", "guessed"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("guessed")), zero).alias("f1"),
        "support",
    )


def classification_report(pred: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Rows per label, then 'accuracy', 'macro avg' and 'weighted avg'."""
    scores = stage(label_scores(confusion(pred, truth, predicted)), "report")
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    weighted = scores.agg(*[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names], total.alias("support"))
    macro = scores.agg(*[F.avg(c).alias(c) for c in names], total.alias("support"))
    right = F.sum(F.col("recall") * F.col("support")) / total
    accuracy = scores.agg(*[right.alias(c) for c in names], total.alias("support"))
    rows = scores
    for name, frame in (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)):
        rows = rows.unionByName(frame.withColumn("label", F.lit(name)))
    return rows


def accuracy(pred: DataFrame, truth: str = "truth", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, accuracy)."""
    right = share(F.col(truth).eqNullSafe(F.col(predicted)))
    return pred.groupBy(*by).agg(F.count("*").alias("n"), right.alias("accuracy"))


def balanced_accuracy(pred: DataFrame, truth: str = "truth", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Mean recall over the labels present in the truth."""
    recall = pred.groupBy(*by, truth).agg(share(F.col(truth).eqNullSafe(F.col(predicted))).alias("_recall"))
    return recall.groupBy(*by).agg(F.avg("_recall").alias("balanced_accuracy"))


def cohen_kappa(pred: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(po - pe) / (1 - pe) from the confusion table."""
    labels = per_label(confusion(pred, truth, predicted))
    n = F.sum("support")
    po = F.sum("tp") / n
    pe = F.sum(F.col("support").cast("double") * F.col("guessed")) / (n * n)
    return labels.agg(po.alias("po"), pe.alias("pe")).select(
        F.coalesce(F.try_divide(F.col("po") - F.col("pe"), 1 - F.col("pe")), F.lit(0.0)).alias("kappa")
    )


def binary_counts(truth: Column, predicted: Column) -> list[Column]:
    """tn, fp, fn, tp of 0/1 columns as aggregates."""
    return [
        F.count_if((truth == 0) & (predicted == 0)).alias("tn"),
        F.count_if((truth == 0) & (predicted == 1)).alias("fp"),
        F.count_if((truth == 1) & (predicted == 0)).alias("fn"),
        F.count_if((truth == 1) & (predicted == 1)).alias("tp"),
    ]


def binary_metrics(pred: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """One row: the four counts and the scores that follow from them."""
    counts = pred.agg(*binary_counts(F.col(truth), F.col(predicted)))
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select(
        "tn", "fp", "fn", "tp",
        F.try_divide(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide(F.col("fp") + F.col("fn"), total).alias("misclassification_rate"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


# ---- curves ---------------------------------------------------------------------------------------------------------


def score_steps(pred: DataFrame, truth: str = "truth", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg, cum_pos, cum_neg): one row per distinct score, from the highest down.

    Equal scores are merged first, so a score shared by a third of all rows is one row before anything is ordered.
    """
    merged = pred.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(truth) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(truth) == 1, 0).otherwise(1)).alias("neg"),
    )
    return stage(running_totals(stage(merged, "scores"), "score", ["pos", "neg"], groups=by), "score-steps")


def roc_points(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, fpr, tpr) per threshold."""
    totals = steps.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    joined = _attach(steps, totals, by)
    return joined.select(
        *by, "score", F.try_divide("cum_neg", "_n").alias("fpr"), F.try_divide("cum_pos", "_p").alias("tpr")
    )


def _attach(steps: DataFrame, totals: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return steps.join(totals, list(by))
    return steps.withColumns(
        {"_p": totals.select("_p").scalar(), "_n": totals.select("_n").scalar()}
    )


def auc(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve: for every step the trapezoid under the rise of tpr."""
    area = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0))
    return steps.groupBy(*by).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def average_precision(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of precision times the rise of recall."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return steps.groupBy(*by).agg(
        F.try_divide(F.sum(precision * F.col("pos")), F.sum("pos").cast("double")).alias("average_precision")
    )


def log_loss(truth: Column, p: Column) -> Column:
    """Mean negative log likelihood of 0/1 truth, probabilities clipped away from 0 and 1."""
    safe = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return -F.avg(F.when(truth == 1, F.log(safe)).otherwise(F.log(1 - safe)))


def metric_panel(pred: DataFrame, truth: str = "truth", predicted: str = "predicted", score: str = "score") -> DataFrame:
    """One row with every binary score: accuracy, recall, auc, precisions, f1, r2, log loss, mean squared error.

    ``predicted`` is the 0/1 class, ``score`` the probability of class 1. R2 and MSE use the class, AUC, average
    precision and log loss the probability.
    """
    pred = stage(pred.select(truth, predicted, score), "judged")
    t, y = F.col(truth), F.col(predicted)
    base = pred.agg(
        *binary_counts(t, y),
        log_loss(t, F.col(score)).alias("logloss"),
        F.avg((t - y) * (t - y)).alias("mse"),
        F.var_pop(t.cast("double")).alias("_var"),
    )
    steps = score_steps(pred, truth, score)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    zero = F.lit(0.0)
    positive = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), zero)
    negative = F.coalesce(F.try_divide(F.col("tn"), F.col("tn") + F.col("fn")), zero)
    return base.select(
        F.try_divide(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), zero).alias("recall"),
        auc(steps).scalar().alias("auc"),
        positive.alias("precision"),
        average_precision(steps).scalar().alias("average_precision"),
        F.try_divide(F.col("tp") + F.col("tn"), total).alias("precision_micro"),
        ((positive + negative) / 2).alias("precision_macro"),
        F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero).alias("f1"),
        (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"),
        "logloss",
        "mse",
    )


# ---- rows and confidence --------------------------------------------------------------------------------------------


def attach_predictions(pred: DataFrame, truth: DataFrame, features: DataFrame, key: str = "id") -> DataFrame:
    """Predictions, true labels and features side by side; a row missing on one side keeps nulls there."""
    return pred.join(truth, key, "full_outer").join(features, key, "full_outer")


def wrongly_classified(
    joined: DataFrame, truth: str = "truth", predicted: str = "predicted", correct: bool = False
) -> DataFrame:
    """Rows whose prediction differs from the truth, or agrees when ``correct`` is set."""
    same = F.col(truth).eqNullSafe(F.col(predicted))
    return joined.filter(same if correct else ~same)


def confidence_counts(pred: DataFrame, min_conf: float, top: str = "top_p", truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(right_sure, wrong_sure, right_all, n): rows above the confidence bound, split by outcome."""
    right = F.col(truth).eqNullSafe(F.col(predicted))
    sure = F.col(top) > min_conf
    return pred.agg(
        F.count_if(right & sure).alias("right_sure"),
        F.count_if(~right & sure).alias("wrong_sure"),
        F.count_if(right).alias("right_all"),
        F.count("*").alias("n"),
    )


def check_confidence(pred: DataFrame, min_conf: float, **names) -> DataFrame:
    """(accuracy, coverage, baseline) rounded to four decimals: how good are the answers above a confidence bound?"""
    sure = F.col("right_sure") + F.col("wrong_sure")
    return confidence_counts(pred, min_conf, **names).select(
        F.round(F.try_divide(F.col("right_sure"), sure), 4).alias("accuracy"),
        F.round(F.try_divide(sure, F.col("n")), 4).alias("coverage"),
        F.round(F.try_divide(F.col("right_all"), F.col("n")), 4).alias("baseline"),
    )


# ---- multi-label ----------------------------------------------------------------------------------------------------


def multilabel_counts(pred: DataFrame, labels: Sequence[str], truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(label, tp, fp, fn) for tag arrays, one pass with conditional counts per label."""
    aggs = []
    for i, label in enumerate(labels):
        t, p = F.array_contains(truth, label), F.array_contains(predicted, label)
        aggs += [F.count_if(t & p).alias(f"tp{i}"), F.count_if(~t & p).alias(f"fp{i}"), F.count_if(t & ~p).alias(f"fn{i}")]
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("label"), *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn")])
            for i, label in enumerate(labels)
        ]
    )
    return pred.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def multilabel_report(pred: DataFrame, labels: Sequence[str], truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """(label, precision, recall, f1, support) per label of tag arrays; undefined values are 0."""
    zero = F.lit(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return multilabel_counts(pred, labels, truth, predicted).select(
        "label",
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        (tp + fn).alias("support"),
    )


def subset_accuracy(pred: DataFrame, labels: Sequence[str], truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Share of rows whose whole label set is right, and the macro F1 over labels."""
    wanted = F.array(*[F.lit(x) for x in labels])

    def as_set(name: str) -> Column:
        return F.array_sort(F.array_intersect(wanted, F.col(name)))

    exact = scalar_of(pred, share(as_set(truth) == as_set(predicted)))
    return multilabel_report(pred, labels, truth, predicted).agg(F.avg("f1").alias("macro_f1")).select(
        exact.alias("subset_accuracy"), "macro_f1"
    )


# ---- registry of scorers --------------------------------------------------------------------------------------------

SCORERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "accuracy": lambda p: accuracy(p).select("accuracy"),
    "balanced_accuracy": balanced_accuracy,
    "kappa": cohen_kappa,
    "f1": lambda p: binary_metrics(p).select("f1"),
    "precision": lambda p: binary_metrics(p).select("precision"),
    "recall": lambda p: binary_metrics(p).select("recall"),
    "f1_macro": lambda p: label_scores(confusion(p)).agg(F.avg("f1").alias("f1_macro")),
    "roc_auc": lambda p: auc(score_steps(p)),
    "average_precision": lambda p: average_precision(score_steps(p)),
    "log_loss": lambda p: p.agg(log_loss(F.col("truth"), F.col("score")).alias("log_loss")),
    "mean_squared_error": lambda p: p.agg(
        F.avg((F.col("truth") - F.col("predicted")) * (F.col("truth") - F.col("predicted"))).alias("mse")
    ),
    "r2": lambda p: p.agg(
        (
            1 - F.try_divide(
                F.avg((F.col("truth") - F.col("predicted")) * (F.col("truth") - F.col("predicted"))),
                F.var_pop(F.col("truth").cast("double")),
            )
        ).alias("r2")
    ),
}


def score(pred: DataFrame, name: str) -> float | None:
    """One metric by name as a number."""
    return SCORERS[name](pred).first()[0]
