"""Soft voting over the class probabilities of several models, the search for the vote weights, and ensembles that fit their members."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.literals import sql_array
from textmill.operators.metrics import CLIP
from textmill.operators.splits import random_split
from textmill.staging import stage


def unit_weights(weights: Sequence[float]) -> list[float]:
    """Absolute values scaled to sum 1."""
    total = sum(abs(w) for w in weights)
    if total == 0:
        raise ValueError("at least one weight must differ from zero")
    return [abs(w) / total for w in weights]


def vote_proba(probs: DataFrame, weights: dict[str, float], key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., label, p): weighted mean of the probabilities in long form (key, model, label, p)."""
    names = list(weights)
    scaled = dict(zip(names, unit_weights([weights[n] for n in names]), strict=True))
    weight = F.lit(0.0)
    for name, w in scaled.items():
        weight = F.when(F.col("model") == name, F.lit(w)).otherwise(weight)
    return probs.groupBy(key, *keep, "label").agg(F.sum(weight * F.col("p")).alias("p"))


def vote(probs: DataFrame, weights: dict[str, float], key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted, p): label with the largest weighted probability; among equals the first label."""
    return best_label(vote_proba(probs, weights, key, keep), key, keep)


def best_label(probs: DataFrame, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted, p) from long probabilities."""
    first = F.struct(-F.round("p", 12), F.col("label"))
    return probs.groupBy(key, *keep).agg(F.min_by("label", first).alias("predicted"), F.max("p").alias("p"))


def weight_grid(n_models: int, steps: int = 10) -> list[tuple[float, ...]]:
    """All weight vectors with entries in multiples of 1/steps that sum to 1."""
    grid = itertools.product(range(steps + 1), repeat=n_models - 1)
    return [tuple(x / steps for x in (*head, steps - sum(head))) for head in grid if sum(head) <= steps]


def pivot_models(probs: DataFrame, models: Sequence[str], key: str, truth: str) -> DataFrame:
    """(key, truth, entries): one row per key with (label, p0, p1, ...) of every label; a label a model does not know has 0 there."""
    cols = [F.coalesce(F.sum(F.when(F.col("model") == m, F.col("p"))), F.lit(0.0)).alias(f"p{i}") for i, m in enumerate(models)]
    flat = probs.groupBy(key, truth, "label").agg(*cols)
    entries = F.collect_list(F.struct("label", *[f"p{i}" for i in range(len(models))])).alias("entries")
    return flat.groupBy(key, truth).agg(entries)


def candidate_confusion(wide: DataFrame, candidates: Sequence[Sequence[float]], truth: str = "truth") -> DataFrame:
    """(candidate, truth, predicted, n) of every candidate over the rows of :func:`pivot_models`, in one job.

    The candidates are a small table of (candidate, weights); every row meets each of them once and is counted where it lies,
    so what moves is one confusion table per task, whatever the number of rows. Among equally likely labels the first one wins.
    """
    scaled = [unit_weights(c) for c in candidates]
    n_models = len(scaled[0])
    table = ", ".join(f"named_struct('candidate', {i}L, 'weights', {sql_array(w)})" for i, w in enumerate(scaled))
    met = wide.select(F.col(truth).alias("truth"), "entries", F.explode(F.expr(f"array({table})")).alias("c"))

    def mixed(entry: Column) -> Column:
        total = F.lit(0.0)
        for i in range(n_models):
            total = total + F.col("c.weights")[i] * entry[f"p{i}"]
        return F.round(total, 12)

    best = F.array_min(F.transform("entries", lambda e: F.struct((-mixed(e)).alias("s"), e["label"].alias("label"))))
    voted = met.select(F.col("c.candidate").alias("candidate"), "truth", best["label"].alias("predicted"))
    return voted.groupBy("candidate", "truth", "predicted").agg(F.count("*").alias("n"))


# ---- scores of confusion rows ---------------------------------------------------------------------------------------


def _shares(cm: DataFrame, value: Column) -> DataFrame:
    return cm.groupBy("candidate").agg((F.sum(value * F.col("n")) / F.sum("n")).alias("score"))


def _agreement(cm: DataFrame) -> DataFrame:
    return _shares(cm, F.when(F.col("truth").eqNullSafe(F.col("predicted")), 1.0).otherwise(0.0))


def _by_label(cm: DataFrame) -> DataFrame:
    """(candidate, label, tp, support, guessed)."""
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), none.alias("guessed")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), F.col("n").alias("guessed")),
    )
    hit = F.when(F.col("truth").eqNullSafe(F.col("predicted")), F.col("s.support")).otherwise(none)
    flat = cm.select("candidate", "truth", "predicted", F.explode(sides).alias("s"))
    return flat.groupBy("candidate", "s.label").agg(F.sum(hit).alias("tp"), F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed"))


def _macro(value: Callable[[], Column], where: str = "true") -> Callable[[DataFrame], DataFrame]:
    def run(cm: DataFrame) -> DataFrame:
        return _by_label(cm).filter(where).groupBy("candidate").agg(F.avg(F.coalesce(value(), F.lit(0.0))).alias("score"))

    return run


def _kappa(cm: DataFrame) -> DataFrame:
    n = F.sum("support")
    sums = _by_label(cm).groupBy("candidate").agg(
        (F.sum("tp") / n).alias("po"), (F.sum(F.col("support").cast("double") * F.col("guessed")) / (n * n)).alias("pe")
    )
    return sums.select("candidate", F.coalesce(F.try_divide(F.col("po") - F.col("pe"), 1 - F.col("pe")), F.lit(0.0)).alias("score"))


def _two_class(value: Callable[[Column, Column, Column, Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """Score of labels 0 and 1 from (tp, fp, fn, tn); other labels count as 0. Undefined values are 0."""

    def run(cm: DataFrame) -> DataFrame:
        is_true, is_hit = (F.coalesce(F.col(c).cast("string"), F.lit("0")) == "1" for c in ("truth", "predicted"))
        cells = {"tp": is_true & is_hit, "fp": ~is_true & is_hit, "fn": is_true & ~is_hit, "tn": ~is_true & ~is_hit}
        sums = cm.groupBy("candidate").agg(*[F.sum(F.when(test, F.col("n")).otherwise(0)).alias(name) for name, test in cells.items()])
        return sums.select("candidate", F.coalesce(value(*[F.col(c) for c in cells]), F.lit(0.0)).alias("score"))

    return run


def _squares() -> Column:
    gap = F.col("truth").cast("double") - F.col("predicted").cast("double")
    return gap * gap


def _r2(cm: DataFrame) -> DataFrame:
    y, n = F.col("truth").cast("double"), F.sum("n")
    mean = F.sum(y * F.col("n")) / n
    variance = F.sum(y * y * F.col("n")) / n - mean * mean
    return cm.groupBy("candidate").agg(F.coalesce(1 - F.try_divide(F.sum(_squares() * F.col("n")) / n, variance), F.lit(0.0)).alias("score"))


def _positive_area(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Average precision of two-valued scores: the positive guesses first, then all rows."""
    recall, base = F.try_divide(tp, tp + fn), (tp + fn) / (tp + fp + fn + tn)
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)) * recall + base * (1 - recall)


SCORERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "accuracy": _agreement,
    "balanced_accuracy": _macro(lambda: F.try_divide("tp", "support"), "support > 0"),
    "f1_macro": _macro(lambda: F.try_divide(2 * F.col("tp"), F.col("support") + F.col("guessed"))),
    "precision_macro": _macro(lambda: F.try_divide("tp", "guessed")),
    "recall_macro": _macro(lambda: F.try_divide("tp", "support")),
    "kappa": _kappa,
    "f1": _two_class(lambda tp, fp, fn, tn: F.try_divide(2 * tp, 2 * tp + fp + fn)),
    "precision": _two_class(lambda tp, fp, fn, tn: F.try_divide(tp, tp + fp)),
    "recall": _two_class(lambda tp, fp, fn, tn: F.try_divide(tp, tp + fn)),
    "roc_auc": _two_class(lambda tp, fp, fn, tn: (F.try_divide(tp, tp + fn) + F.try_divide(tn, fp + tn)) / 2),
    "average_precision": _two_class(_positive_area),
    "mean_squared_error": lambda cm: _shares(cm, _squares()),
    "r2": _r2,
    "log_loss": lambda cm: _shares(cm, F.when(F.col("truth").eqNullSafe(F.col("predicted")), -math.log1p(-CLIP)).otherwise(-math.log(CLIP))),
}
# scores of which the smallest is the best
LOSSES = ("mean_squared_error", "log_loss")


def score_candidates(wide: DataFrame, candidates: Sequence[Sequence[float]], truth: str = "truth", scorer: str = "accuracy") -> DataFrame:
    """(candidate, weights, <scorer>) over the rows of :func:`pivot_models`; the score is that of the voted labels."""
    if scorer not in SCORERS:
        raise ValueError(f"unknown scorer {scorer!r}; known are {sorted(SCORERS)}")
    scaled = ", ".join(sql_array(unit_weights(c)) for c in candidates)
    scored = SCORERS[scorer](candidate_confusion(wide, candidates, truth))
    weights = F.element_at(F.expr(f"array({scaled})"), (F.col("candidate") + 1).cast("int")).alias("weights")
    return scored.select("candidate", weights, F.col("score").alias(scorer))


def score_vote_weights(
    probs: DataFrame,
    models: Sequence[str],
    candidates: Sequence[Sequence[float]],
    key: str = "id",
    truth: str = "truth",
    scorer: str = "accuracy",
) -> DataFrame:
    """(candidate, weights, <scorer>) of every candidate, in one job."""
    return score_candidates(pivot_models(probs, models, key, truth), candidates, truth, scorer)


def _best(scores: DataFrame, scorer: str):
    value = F.round(scorer, 12)
    return scores.orderBy(value if scorer in LOSSES else F.desc(value), "candidate").first()


def fit_vote_weights(scores: DataFrame, models: Sequence[str], scorer: str = "accuracy") -> dict[str, float]:
    """Weights of the best candidate; among equals the first one."""
    return dict(zip(models, _best(scores, scorer)["weights"], strict=True))


def search_vote_weights(
    probs: DataFrame, models: Sequence[str], key: str = "id", truth: str = "truth", scorer: str = "accuracy", step: float = 0.25, least: float = 0.01
) -> tuple[dict[str, float], float]:
    """(weights, score): local search on the simplex, for any number of models.

    The first round scores equal weights and every model alone. Each later round moves ``step`` of weight between two models, for
    all ordered pairs, in one job over the rows pivoted once; without a better candidate the step is halved, and the search ends
    below ``least``. At most models x (models - 1) candidates are scored in a round; only better ones are taken, so it always ends
    and the result is never worse than equal weights or one model.
    """
    names = list(models)
    n = len(names)
    wide = stage(pivot_models(probs, names, key, truth), "votes")

    def judged(candidates: list[list[float]]) -> tuple[list[float], float]:
        row = _best(score_candidates(wide, candidates, truth, scorer), scorer)
        if row is None:
            raise ValueError("there are no rows to judge weights on")
        return list(row["weights"]), round(row[scorer], 12)

    weights, score = judged([[1 / n] * n, *[[float(i == j) for j in range(n)] for i in range(n)]])
    while step >= least and n > 1:
        moves = []
        for taken, given in itertools.permutations(range(n), 2):
            share = min(step, weights[taken])
            if share > 0:
                moves.append([w - share if i == taken else w + share if i == given else w for i, w in enumerate(weights)])
        moved, found = judged(moves)
        if (found < score) if scorer in LOSSES else (found > score):
            weights, score = moved, found
        else:
            step /= 2
    return dict(zip(names, weights, strict=True)), score


# ---- an ensemble that fits its members ------------------------------------------------------------------------------


@dataclass
class Member:
    """One model of an ensemble: how it is fitted, and how it gives (key, label, p) for rows."""

    fit: Callable[[DataFrame], Any]
    probabilities: Callable[[Any, DataFrame], DataFrame]


@dataclass
class VotingModel:
    """Fitted members and their weights."""

    members: dict[str, Member]
    fitted: dict[str, Any]
    weights: dict[str, float]
    key: str = "id"

    def member_probabilities(self, rows: DataFrame) -> DataFrame:
        """(key, model, label, p) of all members."""
        parts = [
            member.probabilities(self.fitted[name], rows).select(self.key, F.lit(name).alias("model"), "label", "p")
            for name, member in self.members.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def predict_proba(self, rows: DataFrame) -> DataFrame:
        """(key, label, p)."""
        return vote_proba(self.member_probabilities(rows), self.weights, self.key)

    def predict(self, rows: DataFrame) -> DataFrame:
        """(key, predicted, p)."""
        return vote(self.member_probabilities(rows), self.weights, self.key)


def fit_voting(
    rows: DataFrame,
    members: dict[str, Member],
    label: str = "label",
    key: str = "id",
    weights: dict[str, float] | None = None,
    split_data: bool = True,
    test_size: float = 0.33,
    seed: int = 15,
    prefit: dict[str, Any] | None = None,
    scorer: str = "accuracy",
    candidates: Sequence[Sequence[float]] | None = None,
) -> VotingModel:
    """Fit every member and find the weights of a soft vote.

    ``rows`` may be texts, vectors or term counts; rows of one key stay together. With ``split_data`` members learn from
    1 - ``test_size`` of the keys and the weights are judged on the rest (repeatable by ``seed``); without it both see all rows. With
    ``prefit``, the fitted models by name, nothing is fitted and all rows judge. Given ``weights`` are kept, else the best of
    ``candidates`` is taken, or of a local search where there are none.
    """
    training = held_out = rows
    if split_data and prefit is None:
        marked = random_split(rows, key, test_size, seed, "_part")
        training, held_out = (marked.filter(F.col("_part") == part).drop("_part") for part in ("train", "eval"))
    fitted = dict(prefit) if prefit is not None else {name: member.fit(training) for name, member in members.items()}
    model = VotingModel(members, fitted, weights or {}, key)
    if weights is None:
        truths = held_out.select(key, F.col(label).alias("truth")).distinct()
        probs = model.member_probabilities(held_out).join(truths, key)
        names = list(members)
        if candidates is None:
            model.weights = search_vote_weights(probs, names, key, "truth", scorer)[0]
        else:
            model.weights = fit_vote_weights(score_vote_weights(probs, names, candidates, key, "truth", scorer), names, scorer)
    return model
