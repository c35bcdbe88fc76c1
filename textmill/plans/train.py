"""Training jobs: split -> features -> fit -> judge on both sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.tags import build_tag, first_label
from textmill.functions.text import model_text
from textmill.operators import bayes, features, learners, metrics, vote
from textmill.operators.splits import hash_sample, with_split
from textmill.staging import stage


@dataclass(frozen=True)
class TrainParams:
    """Parameters of a training job; percent units for ``eval_size``."""

    eval_size: float = 20
    frac: float = 1.0
    max_df: float | int = 1.0
    min_df: float | int = 1
    norm: str | None = "l2"
    alpha: float = 1.0
    ngram_range: tuple[int, int] = (1, 1)
    nb_label: int | None = None
    max_features: int = features.MAX_FEATURES
    tokenizer: str = "words"
    trees: int = 100

    def checked(self) -> TrainParams:
        """'None' as text means no norm; a document share of 1.0 as lower bound means one document."""
        norm = None if self.norm == "None" else self.norm
        return replace(self, norm=norm, min_df=1 if self.min_df == 1.0 else self.min_df)


def to_model_frame(
    posts: DataFrame, cols: Sequence[str] = ("title", "text_body", "code_body"), allowed: Sequence[str] | None = None, sep: str = ""
) -> DataFrame:
    """(id, label, text) from clean posts: first (allowed) tag as label, text columns joined."""
    tags = F.col("tags") if allowed is None else build_tag(F.col("tags"), allowed)
    return posts.select("id", first_label(tags).alias("label"), model_text(*cols, sep=sep).alias("text"))


def split_frame(frame: DataFrame, params: TrainParams) -> DataFrame:
    """Sampled frame with a ``split`` column."""
    return with_split(hash_sample(frame, params.frac, "id"), "id", params.eval_size)


def staged_counts(frame: DataFrame, params: TrainParams, keep: Sequence[str] = ("label", "split")) -> DataFrame:
    """Term counts of all documents, written once and read by fitting and both predictions."""
    tokens = features.explode_tokens(frame, "text", "id", keep, params.tokenizer, params.ngram_range)
    return stage(features.term_counts(tokens, "id", keep), "counts")


def packed_counts(frame: DataFrame, params: TrainParams, keep: Sequence[str] = ("label", "split")) -> DataFrame:
    """Term counts of all documents, one row per document, written once and read by fitting and both predictions."""
    return stage(features.count_packed(frame, "text", "id", keep, params.tokenizer, params.ngram_range), "counts")


def train_and_evaluate_nb(frame: DataFrame, params: TrainParams = TrainParams()) -> tuple[bayes.LinearModel, DataFrame]:
    """(model, scores): naive Bayes on (id, label, text); scores has one row per split with accuracy and balanced accuracy."""
    model, predictions = nb_predictions(frame, params)
    return model, split_scores(predictions)


def nb_predictions(frame: DataFrame, params: TrainParams = TrainParams()) -> tuple[bayes.LinearModel, DataFrame]:
    """(model, predictions): predictions has (id, label, split, predicted, probability) of every document."""
    params = params.checked()
    split = split_frame(frame, params)
    counts = packed_counts(split, params)
    training = F.col("split") == "train"
    model = bayes.fit_nb(
        counts.filter(training), split.filter(training).select("id", "label"), "label", "id", params.alpha, params.norm,
        min_df=params.min_df, max_df=params.max_df, max_features=params.max_features,
    )
    return model, bayes.predict_proba(counts, model, "id", ["label", "split"])


def nb_member(alpha: float = 1.0, norm: str | None = "l2", use_idf: bool = True, key: str = "id", label: str = "label", **vocab_params) -> vote.Member:
    """Naive Bayes as a member of a voting ensemble whose rows are term counts, packed or (key, label, term, tf)."""

    def fit(counts: DataFrame) -> bayes.LinearModel:
        docs = counts.select(key, label).distinct()
        return bayes.fit_nb(counts, docs, label, key, alpha, norm, use_idf, **vocab_params)

    def probabilities(model: bayes.LinearModel, counts: DataFrame) -> DataFrame:
        return bayes.long_probabilities(bayes.predict_proba(counts, model, key), model.classes, "nb", key)

    return vote.Member(fit, probabilities)


def split_scores(predictions: DataFrame) -> DataFrame:
    """(split, n, accuracy, balanced_accuracy) from one pass over the predictions."""
    right = F.count_if(F.col("label").eqNullSafe(F.col("predicted"))).alias("right")
    per_label = predictions.groupBy("split", "label").agg(F.count("*").alias("_n"), right)
    return per_label.groupBy("split").agg(
        F.sum("_n").alias("n"),
        (F.sum("right") / F.sum("_n")).alias("accuracy"),
        F.avg(F.col("right") / F.col("_n")).alias("balanced_accuracy"),
    )


def train_and_evaluate_rf(frame: DataFrame, params: TrainParams = TrainParams()) -> tuple[learners.LabelModel, DataFrame]:
    """Random forest on TF-IDF vectors, balanced class weights, the same score table."""
    params = params.checked()
    split = split_frame(frame, params)
    training = split.filter(F.col("split") == "train")
    steps = learners.fit_tfidf(
        training, "text", "space", params.ngram_range, params.min_df, params.max_df, params.max_features, params.norm
    )
    vectors = stage(steps.transform(split), "vectors")
    model = learners.fit_rf(vectors.filter(F.col("split") == "train"), "label", params.trees)
    return model, split_scores(model.transform(vectors))


def model_report(frame: DataFrame, params: TrainParams = TrainParams(), details: bool = False, normalize: bool = False) -> dict[str, DataFrame]:
    """Tables of a model study: accuracy, report and confusion, with ``details`` also vocabulary, idf and weight extremes."""
    params = params.checked()
    model, predictions = nb_predictions(frame, params)
    predictions = stage(predictions, "predictions")
    judged = predictions.select("split", F.col("label").alias("truth"), "predicted")
    test = judged.filter(F.col("split") == "eval")
    cm = metrics.confusion(test, normalize=normalize)
    tables = {
        "accuracy": metrics.accuracy(judged, by=["split"]),
        "report": metrics.classification_report(test),
        "confusion": cm,
    }
    if not details:
        return tables
    split = split_frame(frame, params)
    counts = staged_counts(split, params)
    test_counts = counts.filter(F.col("split") == "eval")
    known = features.in_vocab(test_counts, model.weights)
    values = features.normalise(features.tfidf(test_counts, model.weights), params.norm)
    n_test = split.filter(F.col("split") == "eval").select(F.count("*")).scalar()
    tables |= {
        "marginals": metrics.label_marginals(cm),
        "vocabulary": model.weights.select("term", "idf"),
        "term_totals": features.frequent_terms(features.term_totals(known), 30, 10),
        "term_lengths": features.term_length_extremes(model.weights),
        "mean_tfidf": features.extremes(features.mean_tfidf(values, n_test), "mean_tfidf"),
        "idf": features.extremes(model.weights, "idf"),
        "weights": features.extremes(
            model.class_weights().filter(F.col("label") == str(model.classes[0])).select("term", "weight"), "weight"
        ),
    }
    return tables
