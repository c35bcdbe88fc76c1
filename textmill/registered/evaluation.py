"""Splits and scores of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.operators import bayes, metrics, splits
from textmill.plans import train
from textmill.registered import register
from textmill.registered.learning import frame, nb, nb_sql
from textmill.registered.tables import rounded, sql_bucket, sql_hash, table
from textmill.staging import stage

# ---- splits ---------------------------------------------------------------------------------------------------------


@register(
    "stratified_split",
    f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {sql_hash('doc_id', '30')}, doc_id) AS k,
  count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, CASE WHEN k <= round(n * 0.2) THEN 'eval' ELSE 'train' END AS split FROM r
""",
)
def _(spark, sf):
    return splits.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.2)


@register(
    "random_split",
    f"SELECT o_orderkey, CASE WHEN {sql_bucket('o_orderkey', 10000, '15')} < 3300 THEN 'eval' ELSE 'train' END AS split FROM orders",
)
def _(spark, sf):
    return splits.random_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.33, 15)


@register(
    "kfold",
    f"""
SELECT doc_id, CAST({sql_bucket('doc_id', 5, '30')} AS INTEGER) AS plain,
  CAST((row_number() OVER (PARTITION BY lang ORDER BY {sql_hash('doc_id', '30')}, doc_id) - 1) % 3 AS INTEGER) AS stratified FROM documents
""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    plain = splits.kfold(docs, 5, "doc_id", out="plain")
    return splits.kfold(plain, 3, "doc_id", "lang", out="stratified").drop("lang")


# ---- class metrics --------------------------------------------------------------------------------------------------

# the evaluation part is small, so the class metrics look at all documents
_PRED = f"{nb_sql()}, p AS (SELECT label AS truth, predicted FROM pred)"


def judged(spark, sf):
    _, predictions = nb(spark, sf)
    return predictions.select("id", F.col("label").alias("truth"), "predicted", "probability")


@register("confusion", f"WITH {_PRED} SELECT truth, predicted, count(*) AS n FROM p GROUP BY 1, 2")
def _(spark, sf):
    return metrics.confusion(judged(spark, sf))


@register(
    "confusion_normalised",
    f"WITH {_PRED} SELECT truth, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY truth), 6) AS share FROM p GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(metrics.confusion(judged(spark, sf), normalize=True))


@register(
    "label_marginals",
    f"""WITH {_PRED} SELECT 'actual' AS side, truth AS label, count(*) AS n FROM p GROUP BY 2
UNION ALL SELECT 'predicted', predicted, count(*) FROM p GROUP BY 2""",
)
def _(spark, sf):
    return metrics.label_marginals(stage(metrics.confusion(judged(spark, sf)), "confusion"))


@register("accuracy", f"WITH {_PRED} SELECT count(*) AS n, round(avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p")
def _(spark, sf):
    return rounded(metrics.accuracy(judged(spark, sf)))


@register(
    "balanced_accuracy",
    f"""WITH {_PRED}, r AS (SELECT truth, avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) AS recall FROM p GROUP BY 1)
SELECT round(avg(recall), 6) AS balanced_accuracy FROM r""",
)
def _(spark, sf):
    return rounded(metrics.balanced_accuracy(judged(spark, sf)))


@register(
    "cohen_kappa",
    f"""WITH {_PRED}, kn AS (SELECT count(*)::DOUBLE AS n FROM p), a AS (SELECT truth AS l, count(*) AS a FROM p GROUP BY 1),
b AS (SELECT predicted AS l, count(*) AS b FROM p GROUP BY 1),
x AS (SELECT (SELECT avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) FROM p) AS po, (SELECT sum(a * b) FROM a JOIN b USING (l)) / (n * n) AS pe FROM kn)
SELECT round((po - pe) / (1 - pe), 6) AS kappa FROM x""",
)
def _(spark, sf):
    return rounded(metrics.cohen_kappa(judged(spark, sf)))


@register(
    "classification_report",
    f"""WITH {_PRED}, l AS (SELECT truth AS label FROM p UNION SELECT predicted FROM p),
c AS (SELECT label, count(*) FILTER (truth = label AND predicted = label) AS tp, count(*) FILTER (truth = label) AS support,
  count(*) FILTER (predicted = label) AS guessed FROM l, p GROUP BY label),
s AS (SELECT label, coalesce(tp / nullif(guessed, 0), 0)::DOUBLE AS precision, coalesce(tp / nullif(support, 0), 0)::DOUBLE AS recall,
  coalesce(2 * tp / nullif(support + guessed, 0), 0)::DOUBLE AS f1, support FROM c),
r AS (SELECT * FROM s UNION ALL
  SELECT 'accuracy', sum(recall * support) / sum(support), sum(recall * support) / sum(support), sum(recall * support) / sum(support), CAST(sum(support) AS BIGINT) FROM s UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM s UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM s)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r""",
)
def _(spark, sf):
    return rounded(metrics.classification_report(judged(spark, sf)))


@register(
    "wrongly_classified",
    f"""WITH {nb_sql()} SELECT p.id, p.predicted, p.label AS truth, d.lang, d.n_chars FROM pred p JOIN documents d ON d.doc_id = p.id
WHERE p.predicted <> p.label""",
)
def _(spark, sf):
    pred = stage(judged(spark, sf), "predictions")
    features = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    joined = metrics.attach_predictions(pred.select("id", "predicted"), pred.select("id", "truth"), features)
    return metrics.wrongly_classified(joined)


_TOP = f"{nb_sql()}, top AS (SELECT p.label AS truth, p.predicted, max(q.pr) AS top_p FROM pred p JOIN proba q USING (id) GROUP BY p.id, 1, 2)"


def with_top(spark, sf):
    return judged(spark, sf).withColumn("top_p", F.array_max("probability"))


@register(
    "confidence_counts",
    f"""WITH {_TOP} SELECT count(*) FILTER (truth = predicted AND top_p > 0.5) AS right_sure, count(*) FILTER (truth <> predicted AND top_p > 0.5) AS wrong_sure,
count(*) FILTER (truth = predicted) AS right_all, count(*) AS n FROM top""",
)
def _(spark, sf):
    return metrics.confidence_counts(with_top(spark, sf), 0.5)


@register(
    "check_confidence",
    f"""WITH {_TOP}, c AS (SELECT count(*) FILTER (truth = predicted AND top_p > 0.1) AS r, count(*) FILTER (truth <> predicted AND top_p > 0.1) AS w,
count(*) FILTER (truth = predicted) AS b, count(*) AS n FROM top)
SELECT round(r / nullif(r + w, 0), 4) AS accuracy, round((r + w) / n, 4) AS coverage, round(b / n, 4) AS baseline FROM c""",
)
def _(spark, sf):
    return metrics.check_confidence(with_top(spark, sf), 0.1)


@register(
    "model_report",
    f"""WITH {nb_sql('lang')}, p AS (SELECT label AS truth, predicted FROM pred WHERE split = 'eval')
SELECT truth, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY truth), 6) AS share FROM p GROUP BY 1, 2""",
)
def _(spark, sf):
    from textmill.registered.learning import PARAMS

    tables = train.model_report(frame(spark, sf, "lang"), PARAMS, normalize=True)
    return rounded(tables["confusion"])


@register(
    "model_report_details",
    f"""WITH {nb_sql('lang')}, v AS (SELECT id, term, w FROM val WHERE split = 'eval'),
m AS (SELECT term, sum(w) / (SELECT count(*) FROM docs WHERE split = 'eval') AS mean_tfidf FROM v GROUP BY term)
SELECT term, round(mean_tfidf, 6) AS mean_tfidf, 'smallest' AS side FROM (SELECT * FROM m ORDER BY mean_tfidf, term LIMIT 20) UNION ALL
SELECT term, round(mean_tfidf, 6) AS mean_tfidf, 'largest' AS side FROM (SELECT * FROM m ORDER BY mean_tfidf DESC, term LIMIT 20)""",
)
def _(spark, sf):
    from textmill.registered.learning import PARAMS

    return rounded(train.model_report(frame(spark, sf, "lang"), PARAMS, details=True)["mean_tfidf"])


# ---- binary metrics -------------------------------------------------------------------------------------------------

# 0/1 truth: a finished order; score: the price scaled to 0..1, with many ties after rounding
_BINARY = """
b AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS truth, round(o_totalprice / 600000, 2) AS score, o_orderpriority AS grp FROM orders),
q AS (SELECT truth, score, grp, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM b)"""


def binary(spark, sf):
    score = F.round(F.col("o_totalprice") / 600000, 2)
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("truth"), score.alias("score"),
        F.col("o_orderpriority").alias("grp"),
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


_COUNTS = """
c AS (SELECT count(*) FILTER (truth = 0 AND predicted = 0) AS tn, count(*) FILTER (truth = 0 AND predicted = 1) AS fp,
  count(*) FILTER (truth = 1 AND predicted = 0) AS fn, count(*) FILTER (truth = 1 AND predicted = 1) AS tp FROM q)"""


@register(
    "binary_metrics",
    f"""WITH {_BINARY}, {_COUNTS} SELECT tn, fp, fn, tp, round((tp + tn) / (tn + fp + fn + tp), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
round(tp / (tp + fn), 6) AS recall, round((fp + fn) / (tn + fp + fn + tp), 6) AS misclassification_rate, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def _(spark, sf):
    return rounded(metrics.binary_metrics(binary(spark, sf)))


_STEPS = """
g AS (SELECT score, sum(truth) AS pos, sum(1 - truth) AS neg FROM q GROUP BY score),
st AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn,
  sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM g)"""


@register("roc_points", f"WITH {_BINARY}, {_STEPS} SELECT score, round(cn / tn, 6) AS fpr, round(cp / tp, 6) AS tpr FROM st")
def _(spark, sf):
    return rounded(metrics.roc_points(metrics.score_steps(binary(spark, sf))))


_GSTEPS = """
g AS (SELECT grp, score, sum(truth) AS pos, sum(1 - truth) AS neg FROM q GROUP BY grp, score),
st AS (SELECT grp, score, pos, neg, sum(pos) OVER (PARTITION BY grp ORDER BY score DESC) AS cp, sum(neg) OVER (PARTITION BY grp ORDER BY score DESC) AS cn,
  sum(pos) OVER (PARTITION BY grp) AS tp, sum(neg) OVER (PARTITION BY grp) AS tn FROM g)"""


@register("roc_auc", f"WITH {_BINARY}, {_GSTEPS} SELECT grp, round(sum(neg * (cp - pos / 2.0)) / (any_value(tp) * any_value(tn)), 6) AS auc FROM st GROUP BY grp")
def _(spark, sf):
    return rounded(metrics.auc(metrics.score_steps(binary(spark, sf), by=["grp"]), ["grp"]))


@register(
    "average_precision",
    f"WITH {_BINARY}, {_GSTEPS} SELECT grp, round(sum(cp / (cp + cn) * pos) / any_value(tp), 6) AS average_precision FROM st GROUP BY grp",
)
def _(spark, sf):
    return rounded(metrics.average_precision(metrics.score_steps(binary(spark, sf), by=["grp"]), ["grp"]))


@register(
    "roc_per_class",
    f"""WITH {nb_sql()}, q AS (SELECT cls AS grp, round(pr, 9) AS score, CASE WHEN label = cls THEN 1 ELSE 0 END AS truth FROM proba), {_GSTEPS}
SELECT grp AS label, round(sum(neg * (cp - pos / 2.0)) / (any_value(tp) * any_value(tn)), 6) AS auc FROM st GROUP BY grp""",
)
def _(spark, sf):
    model, predictions = nb(spark, sf)
    long = bayes.long_probabilities(predictions, model.classes, "nb", "id", ["split"]).drop("split")
    truth = frame(spark, sf).select("id", F.col("label").alias("actual"))
    scored = long.join(truth, "id").select(
        "label", F.round("p", 9).alias("score"), F.when(F.col("label") == F.col("actual"), 1).otherwise(0).alias("truth")
    )
    return rounded(metrics.auc(metrics.score_steps(scored, by=["label"]), ["label"]))


@register(
    "metric_panel",
    f"""WITH {_BINARY}, {_COUNTS}, {_STEPS}, d AS (SELECT *, least(greatest(score, 1e-15), 1 - 1e-15) AS s FROM q)
SELECT round((tp + tn) / (tn + fp + fn + tp), 6) AS accuracy, round(tp / (tp + fn), 6) AS recall,
  round((SELECT sum(neg * (cp - pos / 2.0)) / (any_value(tp) * any_value(tn)) FROM st), 6) AS auc, round(tp / (tp + fp), 6) AS precision,
  round((SELECT sum(cp / (cp + cn) * pos) / any_value(tp) FROM st), 6) AS average_precision,
  round((tp + tn) / (tn + fp + fn + tp), 6) AS precision_micro, round((tp / (tp + fp) + tn / (tn + fn)) / 2, 6) AS precision_macro,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
  round((SELECT 1 - avg((truth - predicted) * (truth - predicted)) / var_pop(truth) FROM q), 6) AS r2,
  round((SELECT -avg(CASE WHEN truth = 1 THEN ln(s) ELSE ln(1 - s) END) FROM d), 6) AS logloss,
  round((SELECT avg((truth - predicted) * (truth - predicted)) FROM q), 6) AS mse FROM c""",
)
def _(spark, sf):
    return rounded(metrics.metric_panel(binary(spark, sf)))


# every scorer by name over two-class guesses made from lineitem columns
@register(
    "scorer_by_name",
    """
WITH p AS (SELECT CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS t, CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS g, CAST(l_tax * 10 AS DOUBLE) AS s FROM lineitem),
c AS (SELECT count(*)::DOUBLE AS n, sum(t * g)::DOUBLE AS tp, sum((1 - t) * g)::DOUBLE AS fp, sum(t * (1 - g))::DOUBLE AS fn, sum((1 - t) * (1 - g))::DOUBLE AS tn,
  avg((t - g) * (t - g)) AS mse, var_pop(t) AS spread,
  avg(-ln(CASE WHEN t = 1 THEN least(greatest(s, 1e-15), 1 - 1e-15) ELSE 1 - least(greatest(s, 1e-15), 1 - 1e-15) END)) AS loss FROM p),
q AS (SELECT *, tp / (tp + fp) AS pr, tp / (tp + fn) AS re, ((tp + fn) * (tp + fp) + (tn + fp) * (tn + fn)) / (n * n) AS pe FROM c),
h AS (SELECT s, sum(t)::DOUBLE AS pos, sum(1 - t)::DOUBLE AS neg FROM p GROUP BY s),
k AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS ap, sum(neg) OVER (ORDER BY s DESC) AS an FROM h),
a AS (SELECT sum(neg * (ap - pos / 2)) / (sum(pos) * sum(neg)) AS area, sum(pos * ap / (ap + an)) / sum(pos) AS precision FROM k)
SELECT 'accuracy' AS scorer, round((tp + tn) / n, 6) AS score FROM q
UNION ALL SELECT 'balanced_accuracy', round((re + tn / (tn + fp)) / 2, 6) FROM q
UNION ALL SELECT 'kappa', round(((tp + tn) / n - pe) / (1 - pe), 6) FROM q
UNION ALL SELECT 'f1', round(2 * tp / (2 * tp + fp + fn), 6) FROM q
UNION ALL SELECT 'precision', round(pr, 6) FROM q
UNION ALL SELECT 'recall', round(re, 6) FROM q
UNION ALL SELECT 'f1_macro', round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) FROM q
UNION ALL SELECT 'roc_auc', round(area, 6) FROM a
UNION ALL SELECT 'average_precision', round(precision, 6) FROM a
UNION ALL SELECT 'log_loss', round(loss, 6) FROM q
UNION ALL SELECT 'mean_squared_error', round(mse, 6) FROM q
UNION ALL SELECT 'r2', round(1 - mse / spread, 6) FROM q
""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    guesses = lines.select(
        (F.col("l_discount") > 0.05).cast("int").alias("truth"), (F.col("l_tax") > 0.04).cast("int").alias("predicted"),
        (F.col("l_tax") * 10).cast("double").alias("score"),
    )
    guesses = stage(guesses, "guesses")
    rows = None
    for name, scorer in metrics.SCORERS.items():
        value = scorer(guesses)
        row = value.select(F.lit(name).alias("scorer"), F.col(value.columns[0]).cast("double").alias("score"))
        rows = row if rows is None else rows.unionByName(row)
    return rounded(rows)
