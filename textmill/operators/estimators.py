"""pyspark.ml wrappers, so that the relational models can sit in a Pipeline next to built-in steps."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import clean_text, tokenise
from textmill.operators import bayes, features, vote
from textmill.staging import stage


class _HasKey(Params):
    keyCol = Param(Params._dummy(), "keyCol", "unique row key", TypeConverters.toString)

    def key(self) -> str:
        return self.getOrDefault(self.keyCol)


def _count_or_share(value: float) -> float | int:
    return int(value) if value > 1 else value


class TextCleaner(Transformer, HasInputCol, HasOutputCol):
    """Clean text column to clean text column."""

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "clean"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), clean_text(F.col(self.getInputCol())))


class TextNaiveBayes(Estimator, _HasKey, HasInputCol, HasLabelCol):
    """Fit naive Bayes on a text column."""

    alpha = Param(Params._dummy(), "alpha", "additive smoothing", TypeConverters.toFloat)
    norm = Param(Params._dummy(), "norm", "row norm: l1, l2 or None", TypeConverters.toString)
    tokenizer = Param(Params._dummy(), "tokenizer", "tokenizer name", TypeConverters.toString)
    minDf = Param(Params._dummy(), "minDf", "smallest document frequency: a count, or a share below 1", TypeConverters.toFloat)
    maxDf = Param(Params._dummy(), "maxDf", "largest document frequency: a count, or a share up to 1", TypeConverters.toFloat)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "most frequent terms that are kept; 0 keeps all", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, keyCol: str = "id", inputCol: str = "text", labelCol: str = "label", alpha: float = 1.0, norm: str = "l2",
        tokenizer: str = "words", minDf: float = 1.0, maxDf: float = 1.0, maxFeatures: int = 0,
    ):
        super().__init__()
        self._setDefault(
            keyCol="id", inputCol="text", labelCol="label", alpha=1.0, norm="l2", tokenizer="words", minDf=1.0, maxDf=1.0, maxFeatures=0
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextNaiveBayesModel:
        key, label, text = self.key(), self.getLabelCol(), self.getInputCol()
        how = self.getOrDefault(self.tokenizer)
        tokens = features.explode_tokens(dataset, text, key, [label], how)
        counts = stage(features.term_counts(tokens, key, [label]), "counts")
        model = bayes.fit_nb(
            counts, dataset.select(key, label), label, key, self.getOrDefault(self.alpha), self.getOrDefault(self.norm),
            min_df=_count_or_share(self.getOrDefault(self.minDf)), max_df=_count_or_share(self.getOrDefault(self.maxDf)),
            max_features=self.getOrDefault(self.maxFeatures) or None,
        )
        return TextNaiveBayesModel(model, key, text, how)


class TextNaiveBayesModel(Model):
    """Adds ``predicted`` and ``probability`` to a frame with the key and text columns."""

    def __init__(self, model: bayes.LinearModel, key: str, text: str, tokenizer: str):
        super().__init__()
        self.model, self.key, self.text, self.tokenizer = model, key, text, tokenizer

    def _transform(self, dataset: DataFrame) -> DataFrame:
        counts = features.term_counts(features.explode_tokens(dataset, self.text, self.key, (), self.tokenizer), self.key)
        return dataset.join(bayes.predict_proba(counts, self.model, self.key), self.key)


class MeanEmbedding(Transformer, _HasKey, HasInputCol, HasOutputCol):
    """Mean word vector of a text column, given a (term, vector) table."""

    @keyword_only
    def __init__(self, *, vectors: DataFrame = None, keyCol: str = "id", inputCol: str = "text", outputCol: str = "embedding"):
        super().__init__()
        self._setDefault(keyCol="id", inputCol="text", outputCol="embedding")
        self.vectors = vectors
        self._set(**{k: v for k, v in self._input_kwargs.items() if k != "vectors"})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key = self.key()
        tokens = dataset.select(key, F.explode_outer(tokenise(F.col(self.getInputCol()), "punct")).alias("term"))
        means = features.embed_documents(tokens, self.vectors, key)
        return dataset.join(means.select(key, F.col("embedding").alias(self.getOutputCol())), key)


class SoftVote(Estimator, _HasKey, HasLabelCol):
    """Find vote weights on long probabilities (key, truth, model, label, p)."""

    steps = Param(Params._dummy(), "steps", "grid steps between 0 and 1; 0 searches locally, for many models", TypeConverters.toInt)
    scorer = Param(Params._dummy(), "scorer", "name of the score to optimise", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, keyCol: str = "id", labelCol: str = "truth", steps: int = 10, scorer: str = "accuracy"):
        super().__init__()
        self._setDefault(keyCol="id", labelCol="truth", steps=10, scorer="accuracy")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SoftVoteModel:
        names = [r[0] for r in dataset.select("model").distinct().orderBy("model").collect()]
        steps, scorer = self.getOrDefault(self.steps), self.getOrDefault(self.scorer)
        if not steps:
            return SoftVoteModel(vote.search_vote_weights(dataset, names, self.key(), self.getLabelCol(), scorer)[0], self.key())
        scores = vote.score_vote_weights(dataset, names, vote.weight_grid(len(names), steps), self.key(), self.getLabelCol(), scorer)
        return SoftVoteModel(vote.fit_vote_weights(scores, names, scorer), self.key())


class SoftVoteModel(Model):
    """Weighted vote over long probabilities."""

    def __init__(self, weights: dict[str, float], key: str):
        super().__init__()
        self.weights, self.key = weights, key

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keep = [c for c in dataset.columns if c not in (self.key, "model", "label", "p")]
        return vote.vote(dataset, self.weights, self.key, keep)
