"""Models fitted on the test tables."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.functions.tags import powerset_label
from textmill.operators import aggregates, bayes, embedding, features, graph, knn, learners, metrics, sweep, vote
from textmill.operators.ranking import rank_within
from textmill.plans import train
from textmill.registered import register
from textmill.registered.tables import PARTS, folded_words, rounded, sql_bucket, sql_hash, sql_list, sql_words, table, tagged_parts
from textmill.sources.models import save_model
from textmill.staging import checkpoint_root, spread, stage

EVAL = 20
PARAMS = train.TrainParams(eval_size=EVAL, alpha=1.0, norm="l2", tokenizer=folded_words)


def frame(spark, sf, label: str = "source"):
    """(id, label, text) from documents."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col(label).alias("label"), "text")


def nb_sql(label: str = "source", norm: str = "l2", idf: bool = True, alpha: float = 1.0, top: int | None = PARAMS.max_features, p: str = "", min_df: int = 1, held: str = "") -> str:
    """CTEs up to ``{p}pred`` (id, label, split, predicted) and ``{p}proba`` (id, label, split, cls, pr)."""
    weight = {"l2": "v / sqrt(sum(v * v) OVER (PARTITION BY id))", "l1": "v / sum(v) OVER (PARTITION BY id)", "none": "v"}[norm]
    return f"""
{p}docs AS (SELECT doc_id AS id, {label} AS label, text, CASE WHEN {sql_bucket('doc_id')} < {EVAL} THEN 'eval' {held} ELSE 'train' END AS split FROM documents),
{p}tok AS (SELECT id, label, split, unnest({sql_words('text')}) AS term FROM {p}docs),
{p}tf AS (SELECT id, label, split, term, count(*) AS tf FROM {p}tok GROUP BY ALL),
{p}n AS (SELECT count(*)::DOUBLE AS n FROM {p}docs WHERE split = 'train'),
{p}vocab AS (SELECT term, {'ln((1 + (SELECT n FROM ' + p + 'n)) / (1 + count(*))) + 1' if idf else '1.0::DOUBLE'} AS idf, count(*) AS df, sum(tf) AS cf
  FROM {p}tf WHERE split = 'train' GROUP BY term HAVING count(*) >= {min_df}{f' ORDER BY sum(tf) DESC, term LIMIT {top}' if top else ''}),
{p}raw AS (SELECT id, label, split, term, tf * idf AS v FROM {p}tf JOIN {p}vocab USING (term)),
{p}val AS (SELECT id, label, split, term, {weight} AS w FROM {p}raw),
{p}cls AS (SELECT label AS cls, ln(count(*) / (SELECT n FROM {p}n)) AS prior FROM {p}docs WHERE split = 'train' GROUP BY 1),
{p}stc AS (SELECT label AS cls, term, sum(w) AS s FROM {p}val WHERE split = 'train' GROUP BY ALL),
{p}sc AS (SELECT cls, sum(s) AS t FROM {p}stc GROUP BY 1),
{p}wt AS (SELECT c.cls, v.term, ln((coalesce(s.s, 0) + {alpha}) / (c.t + {alpha} * (SELECT count(*) FROM {p}vocab))) AS lw
  FROM {p}sc c CROSS JOIN {p}vocab v LEFT JOIN {p}stc s ON s.cls = c.cls AND s.term = v.term),
{p}sums AS (SELECT id, cls, sum(w * lw) AS s FROM {p}val JOIN {p}wt USING (term) GROUP BY id, cls),
{p}score AS (SELECT d.id, d.label, d.split, c.cls, c.prior + coalesce(s.s, 0) AS s FROM {p}docs d CROSS JOIN {p}cls c
  LEFT JOIN {p}sums s ON s.id = d.id AND s.cls = c.cls),
{p}ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, cls) AS r, max(s) OVER (PARTITION BY id) AS m FROM {p}score),
{p}pred AS (SELECT id, label, split, cls AS predicted FROM {p}ranked WHERE r = 1),
{p}proba AS (SELECT id, label, split, cls, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS pr FROM {p}ranked)
"""


def nb(spark, sf, label: str = "source", **changes):
    from dataclasses import replace

    return train.nb_predictions(frame(spark, sf, label), replace(PARAMS, **changes))


@register(
    "train_and_evaluate",
    f"""WITH {nb_sql('lang')}, r AS (SELECT split, label, count(*) AS n, count(*) FILTER (label = predicted) AS k FROM pred GROUP BY 1, 2)
SELECT split, CAST(sum(n) AS BIGINT) AS n, round(sum(k) / sum(n), 6) AS accuracy, round(avg(k / n), 6) AS balanced_accuracy FROM r GROUP BY split""",
)
def _(spark, sf):
    _, predictions = nb(spark, sf, "lang")
    return rounded(train.split_scores(predictions))


@register("naive_bayes_weights", f"WITH {nb_sql()} SELECT term, cls AS label, round(lw, 6) AS weight FROM wt")
def _(spark, sf):
    model, _ = nb(spark, sf)
    return rounded(model.class_weights())


@register("naive_bayes_predict", f"WITH {nb_sql()} SELECT id, label, split, predicted FROM pred")
def _(spark, sf):
    _, predictions = nb(spark, sf)
    return predictions.select("id", "label", "split", "predicted")


@register("save_model", f"WITH {nb_sql('lang', top=None)} SELECT id, predicted FROM pred")
def _(spark, sf):
    docs = train.split_frame(frame(spark, sf, "lang"), PARAMS)
    counts = train.packed_counts(docs, PARAMS)
    training = F.col("split") == "train"
    fitted = bayes.fit_nb(counts.filter(training), docs.filter(training))
    path = save_model(fitted, f"{checkpoint_root(spark)}/textmill/models-{uuid.uuid4().hex}", "nb")
    return bayes.predict_nb(counts, bayes.LinearModel.load(spark, path)).select("id", "predicted")


@register(
    "naive_bayes_counts",
    f"WITH {nb_sql('lang', 'none', False, 0.4, None)} SELECT id, label, split, predicted FROM pred",
)
def _(spark, sf):
    docs = train.split_frame(frame(spark, sf, "lang"), PARAMS)
    counts = train.packed_counts(docs, PARAMS)
    training = F.col("split") == "train"
    model = bayes.fit_nb(counts.filter(training), docs.filter(training), alpha=0.4, norm=None, use_idf=False)
    return bayes.predict_nb(counts, model, "id", ["label", "split"]).drop("scores")


@register("naive_bayes_probability", f"WITH {nb_sql()} SELECT id, cls AS label, round(pr, 6) AS p FROM proba")
def _(spark, sf):
    model, predictions = nb(spark, sf)
    return rounded(bayes.long_probabilities(predictions, model.classes, "nb").select("id", "label", "p"))


@register(
    "score_terms_join",
    f"WITH {nb_sql('lang', top=None)} SELECT id, cls AS label, round(s, 6) AS score FROM score",
)
def _(spark, sf):
    docs = train.split_frame(frame(spark, sf, "lang"), PARAMS)
    counts = train.packed_counts(docs, PARAMS)
    training = F.col("split") == "train"
    model = bayes.fit_nb(counts.filter(training), docs.filter(training))
    scored = bayes.linear_scores(counts, model)
    names = F.array(*[F.lit(c) for c in model.classes])
    pairs = F.explode(F.arrays_zip(names.alias("label"), F.col("scores").alias("score"))).alias("x")
    return rounded(scored.select("id", pairs).select("id", "x.label", "x.score"))


@register(
    "weight_extremes",
    f"""WITH {nb_sql('lang')}, w AS (SELECT term, lw AS weight FROM wt WHERE cls = 'de')
SELECT term, round(weight, 6) AS weight, 'smallest' AS side FROM (SELECT * FROM w ORDER BY weight, term LIMIT 20) UNION ALL
SELECT term, round(weight, 6) AS weight, 'largest' AS side FROM (SELECT * FROM w ORDER BY weight DESC, term LIMIT 20)""",
)
def _(spark, sf):
    model, _ = nb(spark, sf, "lang")
    one = model.class_weights().filter(F.col("label") == "de").select("term", "weight")
    return rounded(features.extremes(one, "weight"))


# ---- multi-label ----------------------------------------------------------------------------------------------------

LANGS = ["de", "en", "es", "fr"]
SIZES = ["long", "short"]
TAGS_SQL = "[lang, CASE WHEN n_chars > 1500 THEN 'long' ELSE 'short' END]"


def tagged_docs(spark, sf):
    """(id, text, tags, split): language and length class of each document as its tags."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text",
        F.array("lang", F.when(F.col("n_chars") > 1500, "long").otherwise("short")).alias("tags"),
    )
    return train.split_frame(docs, PARAMS)


_OVR = f"""
docs AS (SELECT doc_id AS id, {TAGS_SQL} AS tags, text, CASE WHEN {sql_bucket('doc_id')} < {EVAL} THEN 'eval' ELSE 'train' END AS split FROM documents),
tok AS (SELECT id, tags, split, unnest({sql_words('text')}) AS term FROM docs),
tf AS (SELECT id, tags, split, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT count(*)::DOUBLE AS n FROM docs WHERE split = 'train'),
vocab AS (SELECT term, ln((1 + (SELECT n FROM n)) / (1 + count(*))) + 1 AS idf FROM tf WHERE split = 'train'
  GROUP BY term),
raw AS (SELECT id, tags, split, term, tf * idf AS v FROM tf JOIN vocab USING (term)),
val AS (SELECT id, tags, split, term, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS w FROM raw),
lab AS (SELECT unnest([{sql_list(LANGS + SIZES)}]) AS l),
tot AS (SELECT term, sum(w) AS s FROM val WHERE split = 'train' GROUP BY term),
pos AS (SELECT l, term, sum(w) AS s FROM val, lab WHERE split = 'train' AND list_contains(tags, l) GROUP BY l, term),
grid AS (SELECT lab.l, tot.term, coalesce(pos.s, 0) AS sp, tot.s - coalesce(pos.s, 0) AS sn
  FROM lab CROSS JOIN tot LEFT JOIN pos ON pos.l = lab.l AND pos.term = tot.term),
sums AS (SELECT l, sum(sp) AS tp, sum(sn) AS tn, count(*) AS v FROM grid GROUP BY l),
wt AS (SELECT l, term, ln((sp + 1) / (tp + v)) - ln((sn + 1) / (tn + v)) AS lw FROM grid JOIN sums USING (l)),
prior AS (SELECT l, ln(count(*) FILTER (list_contains(tags, l)) / (SELECT n FROM n))
  - ln(count(*) FILTER (NOT list_contains(tags, l)) / (SELECT n FROM n)) AS b FROM docs, lab WHERE split = 'train' GROUP BY l),
part AS (SELECT id, l, sum(w * lw) AS s FROM val JOIN wt USING (term) GROUP BY id, l),
score AS (SELECT d.id, d.tags, d.split, p.l, p.b + coalesce(part.s, 0) AS s FROM docs d CROSS JOIN prior p
  LEFT JOIN part ON part.id = d.id AND part.l = p.l),
pred AS (SELECT id, tags, split, coalesce(list(l ORDER BY l) FILTER (s > 0), []) AS predicted FROM score GROUP BY id, tags, split)
"""


def ovr_predictions(spark, sf):
    docs = tagged_docs(spark, sf)
    counts = train.packed_counts(docs, PARAMS, ["tags", "split"])
    training = F.col("split") == "train"
    model = bayes.fit_ovr_nb(counts.filter(training), docs.filter(training), LANGS + SIZES)
    return bayes.predict_ovr(counts, model, "id", ["tags", "split"])


@register("one_vs_rest", f"WITH {_OVR} SELECT id, split, array_to_string(predicted, '|') AS predicted FROM pred")
def _(spark, sf):
    return ovr_predictions(spark, sf).select("id", "split", F.array_join("predicted", "|").alias("predicted"))


@register(
    "multilabel_report",
    f"""WITH {_OVR}, x AS (SELECT l, list_contains(tags, l) AS t, list_contains(predicted, l) AS p FROM pred, lab WHERE split = 'eval'),
c AS (SELECT l AS label, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn FROM x GROUP BY l)
SELECT label, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, tp + fn AS support FROM c""",
)
def _(spark, sf):
    test = ovr_predictions(spark, sf).filter("split = 'eval'")
    return rounded(metrics.multilabel_report(test, LANGS + SIZES, "tags"))


@register(
    "multilabel_scores",
    f"""WITH {_OVR}, x AS (SELECT l, list_contains(tags, l) AS t, list_contains(predicted, l) AS p FROM pred, lab WHERE split = 'eval'),
c AS (SELECT l, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn FROM x GROUP BY l)
SELECT round((SELECT avg(CASE WHEN list_sort(tags) = list_sort(predicted) THEN 1.0 ELSE 0.0 END) FROM pred WHERE split = 'eval'), 6) AS subset_accuracy,
  round(avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)), 6) AS macro_f1 FROM c""",
)
def _(spark, sf):
    test = stage(ovr_predictions(spark, sf).filter("split = 'eval'"), "predictions")
    return rounded(metrics.subset_accuracy(test, LANGS + SIZES, "tags"))


def knn_sides(spark, sf):
    docs = tagged_docs(spark, sf)
    counts = train.staged_counts(docs, PARAMS, ["tags", "split"])
    training = F.col("split") == "train"
    n_train = docs.filter(training).select(F.count("*")).scalar()
    vocab = stage(features.index_vocab(features.fit_vocab(counts.filter(training), n_docs=n_train)), "vocab")
    # numbers in place of terms: they are compared as often, and shorter
    known = counts.join(vocab.select("term", "idf", "idx"), "term", "left")
    values = known.select("id", "tags", "split", F.col("idx").alias("term"), "tf", (F.col("tf") * F.col("idf")).alias("value"))
    packed = stage(knn.pack_vectors(values, "id", ["tags", "split"]), "packed")
    return packed.filter(training).drop("split"), packed.filter(~training).drop("split")


@register(
    "ml_knn",
    f"""WITH {_OVR},
v AS (SELECT id, term, w FROM val), tr AS (SELECT id, tags FROM docs WHERE split = 'train'),
sim AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM v a JOIN v b ON a.term = b.term JOIN tr ON tr.id = b.id WHERE a.id <> b.id GROUP BY 1, 2),
near AS (SELECT d.id AS a, t.id AS b, row_number() OVER (PARTITION BY d.id ORDER BY round(coalesce(s, 0), 9) DESC, t.id) AS r
  FROM docs d CROSS JOIN tr t LEFT JOIN sim ON sim.a = d.id AND sim.b = t.id WHERE d.id <> t.id),
votes AS (SELECT a AS id, l, count(*) FILTER (list_contains(tr.tags, l)) AS j FROM near JOIN tr ON tr.id = near.b, lab WHERE r <= 2 GROUP BY a, l),
seen AS (SELECT l, j, count(*) FILTER (list_contains(tags, l)) AS h, count(*) FILTER (NOT list_contains(tags, l)) AS m FROM votes JOIN tr USING (id) GROUP BY l, j),
tots AS (SELECT l, count(*) FILTER (list_contains(tags, l)) AS nh, count(*) FILTER (NOT list_contains(tags, l)) AS nm FROM tr, lab GROUP BY l),
q AS (SELECT v.id, v.l, (1.0 + nh) / (2 + nh + nm) * (1.0 + coalesce(h, 0)) / (3 + nh) AS ph,
  (1 - (1.0 + nh) / (2 + nh + nm)) * (1.0 + coalesce(m, 0)) / (3 + nm) AS pm
  FROM votes v JOIN docs d ON d.id = v.id AND d.split = 'eval' JOIN tots USING (l) LEFT JOIN seen ON seen.l = v.l AND seen.j = v.j)
SELECT id, l AS label, CASE WHEN ph >= pm THEN 1 ELSE 0 END AS predicted, round(ph / (ph + pm), 6) AS p FROM q""",
)
def _(spark, sf):
    train_side, test_side = knn_sides(spark, sf)
    return rounded(knn.ml_knn(train_side, test_side, LANGS + SIZES, k=2, s=1.0))


# ---- voting ---------------------------------------------------------------------------------------------------------

_TWO = f"{nb_sql('lang', 'l2', True, 1.0, None, 'a_')}, {nb_sql('lang', 'none', False, 0.5, None, 'b_')}"


def two_models(spark, sf):
    """Long probabilities (id, truth, model, label, p) of two naive Bayes models on the evaluation part."""
    docs = train.split_frame(frame(spark, sf, "lang"), PARAMS)
    counts = train.packed_counts(docs, PARAMS)
    training = F.col("split") == "train"
    fit = {"docs": docs.filter(training), "counts": counts.filter(training)}
    a = bayes.fit_nb(**fit, alpha=1.0, norm="l2")
    b = bayes.fit_nb(**fit, alpha=0.5, norm=None, use_idf=False)
    test = counts.filter(~training)
    parts = [
        bayes.long_probabilities(bayes.predict_proba(test, m, "id", ["label"]).withColumnRenamed("label", "truth"), m.classes, name, "id", ["truth"])
        for name, m in (("a", a), ("b", b))
    ]
    return stage(parts[0].unionByName(parts[1]), "probabilities")


@register(
    "vote",
    f"""WITH {_TWO}, x AS (SELECT a.id, a.cls, 0.3 * a.pr + 0.7 * b.pr AS p FROM a_proba a JOIN b_proba b ON a.id = b.id AND a.cls = b.cls WHERE a.split = 'eval'),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(p, 12) DESC, cls) AS k FROM x)
SELECT id, cls AS predicted, round(p, 6) AS p FROM r WHERE k = 1""",
)
def _(spark, sf):
    return rounded(vote.vote(two_models(spark, sf), {"a": 0.6, "b": 1.4}))


@register(
    "vote_weights",
    f"""WITH {_TWO}, g AS (SELECT unnest(generate_series(0, 10)) AS candidate),
x AS (SELECT candidate, a.id, a.label, a.cls, round(candidate / 10.0::DOUBLE * a.pr + (10 - candidate) / 10.0::DOUBLE * b.pr, 12) AS p
  FROM g CROSS JOIN a_proba a JOIN b_proba b ON a.id = b.id AND a.cls = b.cls WHERE a.split = 'eval'),
r AS (SELECT *, row_number() OVER (PARTITION BY candidate, id ORDER BY p DESC, cls) AS k FROM x)
SELECT candidate, round(avg(CASE WHEN cls = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM r WHERE k = 1 GROUP BY candidate""",
)
def _(spark, sf):
    scores = vote.score_vote_weights(two_models(spark, sf), ["a", "b"], vote.weight_grid(2, 10))
    return rounded(scores.select("candidate", "accuracy"))


# the third of the training part that the voting ensemble holds back to find its weights
_HELD = f"WHEN {sql_bucket('doc_id', 10000, '15')} < 3300 THEN 'held'"
_ENSEMBLE = f"""{nb_sql('lang', 'l2', True, 1.0, None, 'a_', held=_HELD)}, {nb_sql('lang', 'none', False, 0.5, None, 'b_', held=_HELD)},
g AS (SELECT unnest(generate_series(0, 10)) AS candidate),
x AS (SELECT candidate, a.id, a.split, a.label, a.cls, candidate / 10.0::DOUBLE * a.pr + (10 - candidate) / 10.0::DOUBLE * b.pr AS p
  FROM g CROSS JOIN a_proba a JOIN b_proba b ON a.id = b.id AND a.cls = b.cls WHERE a.split <> 'train'),
r AS (SELECT *, row_number() OVER (PARTITION BY candidate, id ORDER BY round(p, 12) DESC, cls) AS k FROM x),
recalls AS (SELECT candidate, label, avg(CASE WHEN cls = label THEN 1.0 ELSE 0.0 END) AS recall FROM r WHERE k = 1 AND split = 'held' GROUP BY ALL),
best AS (SELECT candidate FROM recalls GROUP BY candidate ORDER BY round(avg(recall), 12) DESC, candidate LIMIT 1)"""


@register(
    "voting_ensemble",
    f"WITH {_ENSEMBLE} SELECT id, cls AS predicted, round(p, 6) AS p FROM r JOIN best USING (candidate) WHERE k = 1 AND split = 'eval'",
)
def _(spark, sf):
    counts = train.packed_counts(train.split_frame(frame(spark, sf, "lang"), PARAMS), PARAMS)
    members = {"a": train.nb_member(), "b": train.nb_member(alpha=0.5, norm=None, use_idf=False)}
    training = F.col("split") == "train"
    model = vote.fit_voting(counts.filter(training), members, scorer="balanced_accuracy", candidates=vote.weight_grid(2, 10))
    return rounded(model.predict(counts.filter(~training)))


_SEARCHED = ("accuracy", "balanced_accuracy", "f1_macro")


@register(
    "vote_weight_search",
    f"""WITH {_TWO}, g(name, w) AS (VALUES ('a', 1.0::DOUBLE), ('b', 0.0::DOUBLE), ('equal', 0.5::DOUBLE)),
x AS (SELECT name, a.id, a.label, a.cls, w * a.pr + (1 - w) * b.pr AS p
  FROM g CROSS JOIN a_proba a JOIN b_proba b ON a.id = b.id AND a.cls = b.cls WHERE a.split = 'eval'),
r AS (SELECT name, label, cls FROM x QUALIFY row_number() OVER (PARTITION BY name, id ORDER BY round(p, 12) DESC, cls) = 1),
n AS (SELECT name, label, count(*) AS n, count(*) FILTER (cls = label) AS tp FROM r GROUP BY ALL),
m AS (SELECT name, cls AS label, count(*) AS m FROM r GROUP BY ALL),
f AS (SELECT name, coalesce(2 * n.tp / (coalesce(n.n, 0) + coalesce(m.m, 0)), 0) AS f1 FROM n FULL JOIN m USING (name, label)),
s AS (SELECT name, 'accuracy' AS scorer, sum(tp) / sum(n) AS score FROM n GROUP BY name UNION ALL
  SELECT name, 'balanced_accuracy', avg(tp / n) FROM n GROUP BY name UNION ALL SELECT name, 'f1_macro', avg(f1) FROM f GROUP BY name)
SELECT name, scorer, round(score, 6) AS score, true AS not_below, true AS same_score, true AS unit_sum FROM s""",
)
def _(spark, sf):
    probs = two_models(spark, sf)
    named = spark.createDataFrame([(0, "a"), (1, "b"), (2, "equal")], "candidate bigint, name string")
    parts = []
    for scorer in _SEARCHED:
        weights, found = vote.search_vote_weights(probs, ["a", "b"], scorer=scorer)
        again = metrics.score(vote.vote(probs, weights, keep=["truth"]), scorer)
        alone = vote.score_vote_weights(probs, ["a", "b"], [(1.0, 0.0), (0.0, 1.0), (0.5, 0.5)], scorer=scorer)
        parts.append(
            alone.join(named, "candidate").select(
                "name", F.lit(scorer).alias("scorer"), F.col(scorer).alias("score"), (F.lit(found) >= F.round(scorer, 12)).alias("not_below"),
                F.lit(abs(again - found) < 1e-9).alias("same_score"), F.lit(abs(sum(weights.values()) - 1) < 1e-9).alias("unit_sum"),
            )
        )
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# ---- mini-batches ---------------------------------------------------------------------------------------------------

BATCH_ROWS = 218

_BATCHES = f"""
docs AS (SELECT doc_id AS id, source AS label, text, CASE WHEN {sql_bucket('doc_id')} < {EVAL} THEN 'eval' ELSE 'train' END AS split FROM documents),
tr AS (SELECT id, label, text, row_number() OVER (ORDER BY {sql_hash('id', 'batch')}, id) AS rank, count(*) OVER () AS n FROM docs WHERE split = 'train'),
bat AS (SELECT id, label, text, CAST((rank - 1) // {BATCH_ROWS} AS BIGINT) AS batch FROM tr),
ttf AS (SELECT id, label, batch, term, count(*) AS tf FROM (SELECT id, label, batch, unnest({sql_words('text')}) AS term FROM bat) GROUP BY ALL),
etf AS (SELECT id, label, term, count(*) AS tf FROM (SELECT id, label, unnest({sql_words('text')}) AS term FROM docs WHERE split = 'eval') GROUP BY ALL),
vocab AS (SELECT term FROM ttf GROUP BY term),
bs AS (SELECT DISTINCT batch AS b FROM bat), cl AS (SELECT DISTINCT label AS c FROM bat),
s AS (SELECT b, label AS c, term, sum(tf) AS s FROM bs JOIN ttf ON batch <= b SEMI JOIN vocab USING (term) GROUP BY ALL),
tot AS (SELECT b, c, coalesce(sum(s), 0) AS t FROM bs CROSS JOIN cl LEFT JOIN s USING (b, c) GROUP BY b, c),
wt AS (SELECT tot.b, tot.c, v.term, ln((coalesce(s.s, 0) + 1) / (tot.t + (SELECT count(*) FROM vocab))) AS lw FROM tot CROSS JOIN vocab v
  LEFT JOIN s ON s.b = tot.b AND s.c = tot.c AND s.term = v.term),
seen AS (SELECT b, count(*) AS n FROM bs JOIN bat ON batch <= b GROUP BY b),
pr AS (SELECT b, label AS c, ln(count(*) / any_value(seen.n)) AS prior FROM bs JOIN bat ON batch <= b JOIN seen USING (b) GROUP BY b, label),
sc AS (SELECT e.id, b, c, sum(tf * lw) AS s FROM etf e JOIN wt USING (term) GROUP BY e.id, b, c),
fin AS (SELECT d.id, d.label, pr.b, pr.c, prior + coalesce(s, 0) AS s FROM docs d CROSS JOIN pr LEFT JOIN sc ON sc.id = d.id AND sc.b = pr.b AND sc.c = pr.c WHERE d.split = 'eval'),
top AS (SELECT *, row_number() OVER (PARTITION BY id, b ORDER BY s DESC, c) AS r FROM fin)
SELECT b AS batch, any_value(seen.n) AS n_train, round(avg(CASE WHEN c = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM top JOIN seen USING (b) WHERE r = 1 GROUP BY b
"""


def batch_history(spark, sf):
    docs = train.split_frame(frame(spark, sf), PARAMS)
    train_docs, test_docs = docs.filter("split = 'train'"), docs.filter("split = 'eval'")
    # only keys and labels are ranked; texts are counted where they lie
    ranked = rank_within(train_docs.select("id", "label"), "id", seed="batch")
    batch = F.expr(f"(rank - 1) div {BATCH_ROWS}")
    batched = stage(ranked.select("id", "label", batch.alias("batch")), "batches")
    counts, test_counts = (features.count_packed(d, "text", "id", ["label"], folded_words, apart=True) for d in (train_docs, test_docs))
    size = train_docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    train_counts, blocks = sweep.fold_blocks(counts, batched, size, "id", "label", "batch")
    return bayes.prequential(train_counts, batched, stage(test_counts, "counts"), test_docs.count(), blocks=blocks)


@register("minibatch_train", f"WITH {_BATCHES}")
def _(spark, sf):
    return rounded(batch_history(spark, sf))


@register(
    "training_history",
    f"WITH {_BATCHES.replace('SELECT b AS batch', ', h AS (SELECT b AS batch', 1)}) "
    "SELECT accuracy, n_train, round(100 * n_train / (SELECT max(n_train) FROM h), 1) AS percent_trained FROM h",
)
def _(spark, sf):
    history = stage(rounded(batch_history(spark, sf)), "history")
    total = history.agg(F.max("n_train").alias("m")).scalar()
    return history.select("accuracy", "n_train", F.round(100 * F.col("n_train") / total, 1).alias("percent_trained"))


# ---- pyspark.ml models ----------------------------------------------------------------------------------------------


def token_lists(docs):
    """The documents with their folded ``words`` in place of the text, cut into words once for the fit and the vectors."""
    return stage(spread(docs).withColumn("words", folded_words(F.col("text"))).drop("text"), "tokens")


def ml_vectors(spark, sf, label: str = "lang", max_features: int = 500):
    """(id, label, split, features) on the folded words of documents."""
    docs = token_lists(train.split_frame(frame(spark, sf, label), PARAMS))
    steps = learners.fit_tfidf(docs.filter("split = 'train'"), "words", None, min_df=2, max_features=max_features)
    return stage(steps.transform(docs).select("id", "label", "split", "features"), "vectors")


@register("random_forest")
def _(spark, sf):
    vectors = ml_vectors(spark, sf)
    model = learners.fit_rf(vectors.filter("split = 'train'"), trees=20, max_depth=6)
    return rounded(train.split_scores(model.transform(vectors)))


@register("linear_svm")
def _(spark, sf):
    vectors = ml_vectors(spark, sf)
    model = learners.fit_svm(vectors.filter("split = 'train'"), reg=1e-2, max_iter=10)
    return rounded(train.split_scores(model.transform(vectors)))


def ml_tagged(spark, sf):
    docs = token_lists(tagged_docs(spark, sf))
    steps = learners.fit_tfidf(docs.filter("split = 'train'"), "words", None, min_df=2, max_features=300)
    return stage(steps.transform(docs).select("id", "tags", "split", "features"), "vectors")


def small_forest(df, label):
    return learners.fit_rf(df, label, trees=10, max_depth=5)


@register("label_powerset")
def _(spark, sf):
    vectors = ml_tagged(spark, sf)
    model = learners.fit_powerset(vectors.filter("split = 'train'"), small_forest)
    predicted = learners.predict_powerset(vectors.filter("split = 'eval'"), model)
    return predicted.select("id", powerset_label(F.col("tags")).alias("truth"), F.array_join("predicted", "|").alias("predicted"))


@register("one_vs_rest_forest")
def _(spark, sf):
    vectors = ml_tagged(spark, sf)
    models = learners.fit_ovr(vectors.filter("split = 'train'"), LANGS + SIZES, small_forest)
    predicted = learners.predict_ovr_models(vectors.filter("split = 'eval'"), models)
    return predicted.select("id", F.array_join("predicted", "|").alias("predicted"))


@register("label_communities")
def _(spark, sf):
    return graph.communities(aggregates.cooccurrence(tagged_parts(spark, sf)))


@register(
    "label_communities_checks",
    f"""WITH {PARTS}, t AS (SELECT DISTINCT id, unnest(tags) AS tag FROM parts), p AS (SELECT DISTINCT a.tag FROM t a JOIN t b ON a.id = b.id AND a.tag <> b.tag)
SELECT count(*) AS labels, true AS once, true AS several, true AS named_after_first, true AS above_propagation FROM p""",
)
def _(spark, sf):
    edges = stage(aggregates.cooccurrence(tagged_parts(spark, sf)), "edges")
    found = graph.communities(edges)
    above = graph.modularity(edges, found) >= graph.modularity(edges, graph.label_propagation(edges)) - 1e-9
    per = found.groupBy("community").agg(F.min("label").alias("first"), F.count("*").alias("n"))
    named = per.agg(F.count("*").alias("k"), F.min(F.col("first") == F.col("community")).alias("named_after_first"))
    return found.agg(F.count("*").alias("labels"), (F.count("*") == F.count_distinct("label")).alias("once")).select(
        "labels", "once", (named.select("k").scalar() > 1).alias("several"), named.select("named_after_first").scalar().alias("named_after_first"), F.lit(above).alias("above_propagation")
    )


@register("community_ensemble")
def _(spark, sf):
    vectors = ml_tagged(spark, sf)
    found = graph.communities(aggregates.cooccurrence(vectors.filter("split = 'train'"))).collect()
    groups: dict[str, list[str]] = {}
    for row in found:
        groups.setdefault(row["community"], []).append(row["label"])
    models = learners.fit_community_ensemble(vectors.filter("split = 'train'"), groups, small_forest)
    predicted = learners.predict_community_ensemble(vectors.filter("split = 'eval'"), models)
    return predicted.select("id", F.array_join("predicted", "|").alias("predicted"))


def word_vectors(spark, sf):
    docs = table(spark, sf, "documents").select(folded_words(F.col("text")).alias("tokens"))
    return embedding.fit_word_vectors(docs)


@register("embed_train")
def _(spark, sf):
    model, vocab = word_vectors(spark, sf)
    return model.vectors(vocab).select("term", "n", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


@register(
    "embed_train_checks",
    f"""WITH tok AS (SELECT unnest({sql_words('text')}) AS term FROM documents)
SELECT count(*) AS terms, 100 AS size, true AS distinct_vectors, true AS neighbours_share_language FROM (SELECT term FROM tok GROUP BY term HAVING count(*) >= 5)""",
)
def _(spark, sf):
    model, vocab = word_vectors(spark, sf)
    vectors = stage(model.vectors(vocab), "vectors")
    # words of one language, the most frequent of each: their nearest words should be of the same one
    words = features.explode_tokens(frame(spark, sf, "lang"), "text", "id", ["label"], folded_words).filter(F.col("term").isNotNull())
    per = words.groupBy("term", "label").agg(F.count("*").alias("n")).groupBy("term").agg(F.max_by("label", F.struct("n", "label")).alias("lang"), F.max("n").alias("most"), F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "term"))
    told = {r["term"]: r["lang"] for r in per.filter(F.col("most") > 0.9 * F.col("n")).withColumn("place", place).filter("place <= 50").collect()}
    near = embedding.nearest_words(vectors, list(told), list(told)).collect()
    share = sum(told[r["term"]] == told[r["other"]] for r in near) / max(len(near), 1)
    sizes = Counter(told.values())
    chance = sum((n - 1) * n for n in sizes.values()) / max(len(told) * (len(told) - 1), 1)
    return vectors.agg(
        F.count("*").alias("terms"), F.max(F.array_size("vector")).alias("size"), (F.count_distinct("vector") > 0.9 * F.count("*")).alias("distinct_vectors"),
        F.lit(share > (1 + chance) / 2).alias("neighbours_share_language"),
    )


def projection(spark, sf):
    docs = frame(spark, sf, "lang")
    counts, blocks = features.bucketed_counts(docs, "text", "id", folded_words)
    n = docs.count()
    return docs, learners.project_packed(counts, blocks, lambda df: features.idf_of(df, n), "l2")


@register("project_2d")
def _(spark, sf):
    docs, found = projection(spark, sf)
    return rounded(docs.select("id", "label").join(found.points, "id"))


@register(
    "project_2d_checks",
    """SELECT count(*) AS points, true AS centred, true AS uncorrelated, true AS ordered, true AS variance_as_told, true AS unit_components, true AS positive_heads
FROM documents""",
)
def _(spark, sf):
    _, found = projection(spark, sf)
    x, y = F.col("x"), F.col("y")
    first, second = found.variances
    near = lambda a, b: F.abs(a - b) < 1e-6
    one = found.points.agg(
        F.count("*").alias("points"), (near(F.avg(x), 0.0) & near(F.avg(y), 0.0)).alias("centred"), near(F.covar_samp(x, y), 0.0).alias("uncorrelated"),
        (F.var_samp(x) >= F.var_samp(y)).alias("ordered"), (near(F.var_samp(x), first) & near(F.var_samp(y), second)).alias("variance_as_told"),
    )
    heads = [F.max_by(c, F.struct(F.abs(c), F.col("term"))) > 0 for c in (x, y)]
    other = found.components.agg((near(F.sum(x * x), 1.0) & near(F.sum(y * y), 1.0) & near(F.sum(x * y), 0.0)).alias("unit_components"), (heads[0] & heads[1]).alias("positive_heads"))
    return one.select("*", other.select("unit_components").scalar().alias("unit_components"), other.select("positive_heads").scalar().alias("positive_heads"))


@register(
    "ml_tfidf",
    f"""WITH {nb_sql('lang', top=100000, min_df=20)} SELECT id, count(*) AS n, round(sum(w), 6) AS total FROM val GROUP BY id""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    values = F.filter(vector_to_array("features"), lambda v: v != 0)
    total = F.aggregate("v", F.lit(0.0), lambda acc, v: acc + v)
    docs = token_lists(train.split_frame(frame(spark, sf, "lang"), PARAMS))
    steps = learners.fit_tfidf(docs.filter("split = 'train'"), "words", None, min_df=20)
    sized = steps.transform(docs).select("id", values.alias("v"))
    return rounded(sized.select("id", F.array_size("v").cast("bigint").alias("n"), total.alias("total")).filter("n > 0"))
