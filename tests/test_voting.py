"""Vote weights for any score, local search on the simplex, ensembles that fit their members."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from textmill.operators import vote
from textmill.operators.estimators import SoftVote, TextNaiveBayes
from textmill.operators.splits import random_split

LABELS = ["0", "1"]


def plain_rows(n=60, models=3):
    """(id, truth, {model: p of label 1}) from a fixed rule; each model is right on other rows."""
    rows = []
    for i in range(n):
        truth = int(i % 3 == 0)
        p = {f"m{j}": ((i * (7 + 4 * j) + 3 * j) % 20) / 20 * 0.6 + (0.4 if truth and (i + j) % 4 else 0.05 * j) for j in range(models)}
        rows.append((i, str(truth), p))
    return rows


def long_rows(spark, rows):
    flat = [(i, t, m, label, p if label == "1" else 1 - p) for i, t, ps in rows for m, p in ps.items() for label in LABELS]
    return spark.createDataFrame(flat, "id int, truth string, model string, label string, p double")


def voted(rows, weights):
    out = []
    for _, truth, ps in rows:
        mix = {label: round(sum(w * (p if label == "1" else 1 - p) for w, p in zip(weights, ps.values(), strict=True)), 12) for label in LABELS}
        out.append((int(truth), int(min(LABELS, key=lambda x: (-mix[x], x)))))
    return out


def plain_scores(pairs):
    n = len(pairs)
    tp, fp, fn, tn = (sum(p == want for p in pairs) for want in ((1, 1), (0, 1), (1, 0), (0, 0)))

    def part(a, b):
        return a / b if b else 0.0

    f1 = {c: part(2 * sum(t == p == c for t, p in pairs), sum(t == c for t, _ in pairs) + sum(p == c for _, p in pairs)) for c in (0, 1)}
    pe = ((tp + fn) * (tp + fp) + (tn + fp) * (tn + fn)) / n**2
    mean = (tp + fn) / n
    recall, precision = part(tp, tp + fn), part(tp, tp + fp)
    return {
        "accuracy": (tp + tn) / n, "balanced_accuracy": (recall + part(tn, tn + fp)) / 2, "f1_macro": (f1[0] + f1[1]) / 2,
        "precision_macro": (precision + part(tn, tn + fn)) / 2, "recall_macro": (recall + part(tn, tn + fp)) / 2,
        "kappa": part((tp + tn) / n - pe, 1 - pe), "f1": f1[1], "precision": precision, "recall": recall,
        "roc_auc": (recall + part(tn, tn + fp)) / 2, "average_precision": precision * recall + mean * (1 - recall),
        "mean_squared_error": (fp + fn) / n, "r2": 1 - (fp + fn) / n / (mean * (1 - mean)),
        "log_loss": (fp + fn) / n * -math.log(1e-15) + (tp + tn) / n * 1e-15,
    }


@pytest.mark.parametrize("scorer", sorted(vote.SCORERS))
def test_every_scorer_against_plain_python(spark, scorer):
    rows = plain_rows()
    candidates = [(1, 0, 0), (0, 1, 0), (0.2, 0.3, 0.5), (0, -2, 2)]
    found = vote.score_vote_weights(long_rows(spark, rows), ["m0", "m1", "m2"], candidates, scorer=scorer).orderBy("candidate").collect()
    assert [r.candidate for r in found] == [0, 1, 2, 3]
    for row, weights in zip(found, candidates, strict=True):
        unit = vote.unit_weights(weights)
        assert row.weights == pytest.approx(unit)
        assert row[scorer] == pytest.approx(plain_scores(voted(rows, unit))[scorer], abs=1e-9)


def test_unknown_scorer_and_unknown_labels(spark):
    probs = long_rows(spark, plain_rows(9, 2))
    with pytest.raises(ValueError):
        vote.score_vote_weights(probs, ["m0", "m1"], [(1, 0)], scorer="beauty")
    # a label that one model does not know counts as probability 0 there
    rows = [(1, "c", "m0", "c", 0.4), (1, "c", "m0", "b", 0.6), (1, "c", "m1", "c", 1.0)]
    short = spark.createDataFrame(rows, "id int, truth string, model string, label string, p double")
    scores = {r.candidate: r.accuracy for r in vote.score_vote_weights(short, ["m0", "m1"], [(1, 0), (0.5, 0.5)]).collect()}
    assert scores == {0: 0.0, 1: 1.0}


@pytest.mark.parametrize("scorer", ["accuracy", "log_loss", "f1"])
def test_local_search_ends_where_no_move_helps(spark, scorer):
    rows, names = plain_rows(60, 4), ["m0", "m1", "m2", "m3"]
    weights, score = vote.search_vote_weights(long_rows(spark, rows), names, scorer=scorer)
    sign = -1 if scorer in vote.LOSSES else 1

    def value(ws):
        return sign * round(plain_scores(voted(rows, ws))[scorer], 9)

    end = [weights[m] for m in names]
    assert sum(end) == pytest.approx(1) and min(end) >= 0 and value(end) == pytest.approx(sign * score, abs=1e-9)
    assert all(value(end) >= value([float(i == j) for j in range(4)]) for i in range(4)) and value(end) >= value([0.25] * 4)
    last = 0.25 / 16
    for a, b in itertools.permutations(range(4), 2):
        share = min(last, end[a])
        moved = [w - share * (i == a) + share * (i == b) for i, w in enumerate(end)]
        assert value(moved) <= value(end)
    assert vote.search_vote_weights(long_rows(spark, rows), ["m1"]) == ({"m1": 1.0}, round(plain_scores(voted([(i, t, {"m1": p["m1"]}) for i, t, p in rows], [1.0]))["accuracy"], 12))


def majority(seen):
    """A member that answers with the label shares of what it was fitted on, and notes the ids."""

    def fit(rows):
        seen.append({r.id for r in rows.select("id").distinct().collect()})
        total = rows.count()
        return rows.groupBy("label").agg((F.count("*") / total).alias("p"))

    def probabilities(model, rows):
        keyed = rows.select("id", F.explode(F.array(*[F.lit(x) for x in LABELS])).alias("label")).distinct()
        return keyed.join(model, "label", "left").select("id", "label", F.coalesce("p", F.lit(0.0)).alias("p"))

    return vote.Member(fit, probabilities)


def truth_teller():
    """A member that knows the answer from the column ``hint``."""
    return vote.Member(lambda rows: None, lambda model, rows: rows.select("id", F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.when(F.col("hint") == x, 0.8).otherwise(0.2).alias("p")) for x in LABELS])).alias("e")).select("id", "e.label", "e.p"))


def test_members_are_fitted_on_two_thirds(spark):
    rows = spark.createDataFrame([(i, str(int(i % 3 == 0)), str(int(i % 3 == 0))) for i in range(300)], "id int, label string, hint string")
    seen = []
    model = vote.fit_voting(rows, {"most": majority(seen), "told": truth_teller()})
    want = {r.id for r in random_split(rows, "id", 0.33, 15).filter("split = 'train'").collect()}
    assert seen == [want] and 170 < len(want) < 230
    assert {r.id: r.predicted for r in model.predict(rows).collect()} == {i: str(int(i % 3 == 0)) for i in range(300)}
    whole = vote.fit_voting(rows, {"most": majority(seen), "told": truth_teller()}, split_data=False, weights={"most": 1, "told": 3})
    assert seen[1] == set(range(300)) and whole.weights == {"most": 1, "told": 3}
    sums = whole.predict_proba(rows).groupBy("id").agg(F.sum("p").alias("p")).filter("abs(p - 1) > 1e-9")
    assert sums.count() == 0
    # fitted members are used as they are, and all rows judge the weights
    ready = vote.fit_voting(rows, whole.members, prefit=whole.fitted, candidates=vote.weight_grid(2, 4))
    assert len(seen) == 2 and ready.weights["told"] > 0
    with pytest.raises(ValueError):
        vote.fit_voting(rows.limit(0), {"told": truth_teller()})


def test_estimator_with_a_score(spark):
    probs = long_rows(spark, plain_rows())
    for steps in (4, 0):
        model = SoftVote(steps=steps, scorer="f1").fit(probs)
        assert sum(model.weights.values()) == pytest.approx(1)
        assert model.transform(probs).count() == 60


def test_vocabulary_parameters(spark):
    rows = [(1, "red apple pie", "a"), (2, "red apple", "a"), (3, "red blue sky", "b"), (4, "red blue", "b")]
    docs = spark.createDataFrame(rows, "id int, text string, label string")

    def terms(**kw):
        return {r.term for r in TextNaiveBayes(**kw).fit(docs).model.weights.collect()}

    assert terms() == {"red", "apple", "pie", "blue", "sky"}
    assert terms(minDf=2.0) == {"red", "apple", "blue"} == terms(minDf=0.5)
    assert terms(maxDf=0.9) == {"apple", "pie", "blue", "sky"} and terms(maxDf=2.0) == terms(maxDf=0.9)
    assert terms(maxFeatures=1) == {"red"}
