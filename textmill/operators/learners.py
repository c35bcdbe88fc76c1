"""pyspark.ml models on TF-IDF vectors: forest, linear SVM, one-vs-rest, powerset, and the projection of sparse rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizer, ElementwiseProduct, IDF, IndexToString, NGram, Normalizer, StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.tags import build_tag, powerset_label
from textmill.functions.text import ngrams, tokenise
from textmill.operators import features
from textmill.operators.aggregates import balanced_weights, with_weights
from textmill.staging import bucket_of, spread, stage, stage_buckets

NORM_P = {"l1": 1.0, "l2": 2.0}


def document_frequency_bound(value: float | int, n_docs: int) -> float:
    """A bound as an absolute count, since Spark reads 1.0 as 'one document' for maxDF."""
    return float(value * n_docs) if isinstance(value, float) else float(value)


@dataclass
class TfidfSteps:
    """Fitted text-to-vector steps. ``transform`` adds a ``features`` column."""

    stages: PipelineModel
    text: str
    tokenizer: str | Callable[[Column], Column] | None
    ngram_range: tuple[int, int]

    def transform(self, df: DataFrame) -> DataFrame:
        tokens = _tokens_of(self.text, self.tokenizer, self.ngram_range)
        return self.stages.transform(df.withColumn("_tokens", tokens)).drop("_tokens", "_counts", "_tfidf", "_scaled")

    @property
    def vocabulary(self) -> list[str]:
        return self.stages.stages[0].vocabulary


def _tokens_of(text: str, tokenizer: str | Callable[[Column], Column] | None, ngram_range: tuple[int, int]) -> Column:
    return ngrams(F.col(text) if tokenizer is None else tokenise(F.col(text), tokenizer), *ngram_range)


def fit_tfidf(
    df: DataFrame,
    text: str = "text",
    tokenizer: str | Callable[[Column], Column] | None = "space",
    ngram_range: tuple[int, int] = (1, 1),
    min_df: float | int = 1,
    max_df: float | int = 1.0,
    max_features: int | None = None,
    norm: str | None = "l2",
) -> TfidfSteps:
    """Counts, idf + 1 and a row norm as pyspark.ml steps. The vocabulary held by the driver has ``max_features`` entries.

    Spark's idf has no '+ 1', so the fitted idf vector is shifted and applied as an element-wise product. Without a tokenizer
    ``text`` is a column of tokens in a written table, which is not written again.
    """
    if min_df == 1.0:
        min_df = 1
    tokens = _tokens_of(text, tokenizer, ngram_range).alias("_tokens")
    tokens = df.select(tokens) if tokenizer is None else stage(spread(df.select(text)).select(tokens), "tokens")
    n_docs = tokens.count()
    counter = CountVectorizer(
        inputCol="_tokens", outputCol="_counts", vocabSize=max_features or 2**31 - 1,
        minDF=document_frequency_bound(min_df, n_docs), maxDF=max(document_frequency_bound(max_df, n_docs), 1.0),
    ).fit(tokens)
    counts = counter.transform(tokens)
    idf = IDF(inputCol="_counts", outputCol="_tfidf").fit(counts).idf
    shifted = ElementwiseProduct(
        inputCol="_counts", outputCol="_scaled", scalingVec=DenseVector([x + 1.0 for x in idf])
    )
    stages = [counter, shifted]
    if norm in NORM_P:
        stages.append(Normalizer(inputCol="_scaled", outputCol="features", p=NORM_P[norm]))
    else:
        shifted.setOutputCol("features")
    return TfidfSteps(PipelineModel(stages), text, tokenizer, ngram_range)


def ngram_step(n: int, input_col: str = "tokens", output_col: str = "ngrams") -> NGram:
    """The pyspark.ml form of one n-gram size."""
    return NGram(n=n, inputCol=input_col, outputCol=output_col)


def label_indexer(label: str = "label", output: str = "label_index") -> StringIndexer:
    """Alphabetical label encoding; unseen labels get an index of their own."""
    return StringIndexer(inputCol=label, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep")


@dataclass
class LabelModel:
    """A fitted pyspark.ml classifier with its label names. ``transform`` adds ``predicted`` and, if any, probabilities."""

    model: PipelineModel
    classes: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if "probability" in out.columns:
            out = out.withColumn("probability", F.slice(vector_to_array("probability"), 1, len(self.classes)))
        return out.drop("label_index", "rawPrediction", "prediction")


def fit_classifier(df: DataFrame, classifier: Estimator, label: str = "label") -> LabelModel:
    """Index labels, fit, and turn predicted indexes back into names."""
    indexer = label_indexer(label).setHandleInvalid("error").fit(df.select(label))
    encoded = indexer.transform(df)
    # a written table is read by few tasks; what one of them holds should not grow with the table
    dealt = spread(encoded, 1)
    if dealt is not encoded:
        dealt.persist()  # else every pass of the fit moves the rows again
    fitted = classifier.fit(dealt)
    if dealt is not encoded:
        dealt.unpersist()
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return LabelModel(PipelineModel([fitted, back]), list(indexer.labels))


def _weighted(df: DataFrame, label: str, class_weight) -> tuple[DataFrame, dict]:
    if class_weight is None:
        return df, {}
    weights = balanced_weights(df, label) if class_weight == "balanced" else class_weight
    return with_weights(df, weights, label, "_weight"), {"weightCol": "_weight"}


def fit_rf(
    df: DataFrame, label: str = "label", trees: int = 100, max_depth: int = 10, class_weight="balanced", seed: int = 30,
    max_memory_mb: int = 512,
) -> LabelModel:
    """Random forest on a ``features`` column. Depth is limited to 30 by Spark."""
    data, extra = _weighted(df, label, class_weight)
    forest = RandomForestClassifier(
        labelCol="label_index", featuresCol="features", numTrees=trees, maxDepth=max_depth, seed=seed,
        maxMemoryInMB=max_memory_mb, **extra,
    )
    return fit_classifier(data, forest, label)


def fit_svm(
    df: DataFrame, label: str = "label", reg: float = 1e-3, max_iter: int = 30, class_weight=None, tol: float = 1e-4,
    parallelism: int = 4,
) -> LabelModel:
    """Linear hinge-loss classifier, one model per class. ``tol`` ends the optimiser early."""
    data, extra = _weighted(df, label, class_weight)
    base = LinearSVC(regParam=reg, maxIter=max_iter, tol=tol)
    ovr = OneVsRest(classifier=base, labelCol="label_index", featuresCol="features", parallelism=parallelism, **extra)
    return fit_classifier(data, ovr, label)


def fit_ovr(df: DataFrame, labels: Sequence[str], base: Callable[[DataFrame, str], LabelModel], tags: str = "tags") -> dict[str, LabelModel]:
    """One binary model per label of a tag array; the labels are a short list, each fit is a distributed job."""
    models = {}
    for label in labels:
        flagged = df.withColumn("_has", F.when(F.array_contains(tags, label), "yes").otherwise("no"))
        models[label] = base(flagged, "_has")
    return models


def predict_ovr_models(df: DataFrame, models: dict[str, LabelModel], key: str = "id", tags: str = "tags") -> DataFrame:
    """(key, tags, predicted array) from one binary model per label."""
    out = df
    for i, (_, model) in enumerate(models.items()):
        out = model.transform(out).withColumnRenamed("predicted", f"_p{i}").drop("probability")
    names = F.array(*[F.when(F.col(f"_p{i}") == "yes", label) for i, label in enumerate(models)])
    return out.select(key, tags, F.array_compact(names).alias("predicted"))


def fit_powerset(df: DataFrame, base: Callable[[DataFrame, str], LabelModel], tags: str = "tags") -> LabelModel:
    """Multi-label by one class per tag set."""
    return base(df.withColumn("_set", powerset_label(F.col(tags))), "_set")


def predict_powerset(df: DataFrame, model: LabelModel, key: str = "id", tags: str = "tags") -> DataFrame:
    """(key, tags, predicted array): the predicted tag set split into tags."""
    out = model.transform(df)
    split = F.filter(F.split("predicted", r"\|"), lambda t: t != "")
    return out.select(key, tags, split.alias("predicted"))


def fit_community_ensemble(
    df: DataFrame, groups: dict[str, list[str]], base: Callable[[DataFrame, str], LabelModel], tags: str = "tags"
) -> dict[str, LabelModel]:
    """One powerset model per label community; the other tags are hidden from it."""
    return {
        name: fit_powerset(df.withColumn(tags, build_tag(F.col(tags), members)), base, tags)
        for name, members in groups.items()
    }


def predict_community_ensemble(df: DataFrame, models: dict[str, LabelModel], key: str = "id", tags: str = "tags") -> DataFrame:
    """(key, tags, predicted array): union of the tag sets predicted by the community models."""
    out = df
    for i, model in enumerate(models.values()):
        scored = model.transform(out).drop("probability")
        out = scored.withColumn(f"_p{i}", F.filter(F.split("predicted", r"\|"), lambda t: t != "")).drop("predicted")
    return out.select(key, tags, F.flatten(F.array(*[F.col(f"_p{i}") for i in range(len(models))])).alias("predicted"))


@dataclass
class Projection:
    """``points`` (key, x, y), ``components`` (term, x, y of unit length) and the variances along them."""

    points: DataFrame
    components: DataFrame
    variances: list[float]
    residual: float


def _combined(column: str, matrix: np.ndarray) -> Column:
    """An array column times a small matrix."""
    return F.expr("array(" + ", ".join(" + ".join(f"{column}[{i}] * {float(x)!r}D" for i, x in enumerate(col)) for col in matrix.T) + ")")


def _at(terms: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Document of each entry, its term, and where the entries of each document begin."""
    lists = terms.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten(), np.cumsum(sizes) - sizes


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32()), pa.array(matrix.ravel()))


def _row_sums(where: np.ndarray, weights: np.ndarray, vectors: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of weighted vectors, vectors[rows[i]] at where[i]; one column is held at a time."""
    return np.stack([np.bincount(where, weights=weights * vectors[rows, j], minlength=n) for j in range(vectors.shape[1])], axis=1).astype(np.float64)


def project_2d(values: DataFrame, key: str = "id", oversampling: int = 6, tol: float = 1e-4, max_rounds: int = 30) -> Projection:
    """The two first principal components of sparse rows (key, term, value); see :func:`project_packed`.

    A key whose rows have no term or value is a point of zeros before centring.
    """
    entry = F.when(F.col("term").isNotNull() & F.col("value").isNotNull(), F.struct("term", F.col("value").cast("double").alias("value")))
    packed = values.groupBy(key).agg(F.collect_list(entry).alias("e"))
    packed = stage(packed.select(key, F.col("e.term").alias("terms"), F.col("e.value").alias("tfs")), "projected-rows")
    n, size = packed.agg(F.count("*"), F.coalesce(F.sum(F.array_size("terms")), F.lit(0))).first()
    blocks = max(values.sparkSession.sparkContext.defaultParallelism, -(-n // features.BUCKET_DOCS), -(-16 * size // features.BUCKET_BYTES))
    block = bucket_of(packed, key, blocks).alias("_block")
    rows = stage_buckets(packed.select(block, key, "terms", "tfs"), "_block", blocks, "projected-blocks")
    return project_packed(rows, blocks, lambda n: F.lit(1.0), None, key, oversampling, tol, max_rounds)


def project_packed(
    rows: DataFrame, blocks: int, idf: Callable[[Column], Column], norm: str | None = "l2", key: str = "id", oversampling: int = 6, tol: float = 1e-4,
    max_rounds: int = 30,
) -> Projection:
    """The two first principal components of packed rows (_block, key, terms, tfs), by randomised subspace iteration.

    ``rows`` are written in ``blocks`` buckets with one row per key. The value of an entry is tf * ``idf`` (of the number of entries
    of its term) over the length of its row where ``norm`` is l2.

    The iteration holds a few directions (2 + ``oversampling``). A round multiplies the centred matrix with them and its
    transpose with the result. The rows never move: a block is sent the directions of its terms and returns one sum per term,
    and the projected rows are the state between the rounds. A term that has one entry needs no direction of its own: it is
    a multiple of its row's point, so a row keeps the sum of squares of such entries, and they are never sent. Only matrices of
    directions times directions reach the driver, which makes the directions orthogonal; the rows of the projection are centred, never
    the rows given. It ends when both residuals |C v - l v| / l are below ``tol``, or with an error after ``max_rounds``. The
    largest weight of a component is positive, ties by the last term. A row without entries is a point of zeros before
    centring; with fewer than two terms or rows, and where nothing varies, coordinates are 0.
    """
    spark, width = rows.sparkSession, 2 + oversampling
    shown = f"`{key}` {rows.schema[key].dataType.simpleString()}"
    per_block = rows.select("_block", F.explode("terms").alias("term")).groupBy("_block", "term").agg(F.count("*").alias("n"))
    terms = per_block.groupBy("term").agg(F.sum("n").alias("n"), F.collect_list("_block").alias("blocks"))
    terms = stage(terms.select("term", "n", idf(F.col("n")).alias("idf"), "blocks"), "projected-terms")
    single_idf = spark.range(1).select(idf(F.lit(1).cast("bigint"))).first()[0]
    start = F.array(*[(F.pmod(F.xxhash64("term", F.lit(i)), F.lit(2_000_003)) / 1_000_001.5 - 1) for i in range(width)])

    def gram(of: DataFrame, column: str, amount: str = "1D") -> np.ndarray:
        cells = ", ".join(f"coalesce(sum({amount} * {column}[{i}] * {column}[{j}]), 0D)" for i in range(width) for j in range(width))
        return np.array(of.agg(F.expr(f"array({cells})").alias("g")).first()["g"]).reshape(width, width)

    def orthonormal(of: np.ndarray) -> np.ndarray:
        """Matrix that turns directions with these products into orthonormal ones; those without length become zero."""
        values, vectors = np.linalg.eigh(of)
        keep = values > max(values.max(), 0.0) * 1e-14
        found = vectors[:, keep][:, ::-1] / np.sqrt(values[keep][::-1]) if keep.any() else np.zeros((width, 0))
        return np.hstack([found, np.zeros((width, width - found.shape[1]))])

    def beside(other: DataFrame, run, schema: str) -> DataFrame:
        """Each block of rows with what was sent to it."""
        return rows.groupBy("_block").cogroup(other.repartition(blocks, "_block").groupBy("_block")).applyInArrow(run, schema)

    def first(docs: pa.Table, known: pa.Table) -> pa.Table:
        at, term, begin = _at(docs["terms"])
        place = pc.index_in(term, value_set=known["term"].combine_chunks()).to_numpy().astype(np.int64)
        value = docs["tfs"].combine_chunks().flatten().to_numpy() * known["idf"].to_numpy()[place]
        n = len(docs)
        size = np.sqrt(np.bincount(at, weights=value * value, minlength=n)) if norm == "l2" else np.ones(n)
        size = np.where(size > 0, size, 1.0)
        value = value / size[at]
        projected = _row_sums(at, value, _matrix(known["q"], width), place, n)
        alone = known["n"].to_numpy()[place] == 1
        single = np.bincount(at[alone], weights=value[alone] ** 2, minlength=n).astype(np.float64)
        ends = np.concatenate([[0], np.cumsum(np.bincount(at[alone], minlength=n))])
        alone = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((np.arange(len(at)) - begin[at])[alone], pa.int32()))
        return pa.table([docs["_block"], docs[key], _lists(projected), pa.array(size), pa.array(single), alone], ["_block", key, "p", "size", "single", "alone"])

    def aligned(docs: pa.Table, state: pa.Table) -> pa.Table:
        return state.take(pc.index_in(docs[key].combine_chunks(), value_set=state[key].combine_chunks()))

    def lone(state: pa.Table, begin: np.ndarray, entries: int) -> np.ndarray:
        lists = state["alone"].combine_chunks()
        mask = np.zeros(entries, bool)
        mask[np.repeat(begin, pc.list_value_length(lists).to_numpy(zero_copy_only=False)) + lists.flatten().to_numpy()] = True
        return mask

    def term_sums(docs: pa.Table, state: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table([pa.array([], pa.string()), pa.array([], pa.list_(pa.float64()))], ["term", "s"])
        state, (at, term, begin) = aligned(docs, state), _at(docs["terms"])
        held = ~lone(state, begin, len(at))
        coded = term.filter(pa.array(held)).dictionary_encode()
        value = (docs["tfs"].combine_chunks().flatten().to_numpy() / state["size"].to_numpy()[at])[held]
        sums = _row_sums(coded.indices.to_numpy(zero_copy_only=False), value, _matrix(state["y"], width), at[held], len(coded.dictionary))
        return pa.table([coded.dictionary, _lists(sums)], ["term", "s"])

    def project(turn: np.ndarray):
        def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
            known = sent.filter(pc.is_valid(sent["term"]))
            state = aligned(docs, sent.filter(pc.is_null(sent["term"])).rename_columns({"r": "y"}))
            at, term, _ = _at(docs["terms"])
            place = pc.index_in(term, value_set=known["term"].combine_chunks())
            found = place.is_valid().to_numpy(zero_copy_only=False)
            place = pc.fill_null(place, 0).to_numpy()[found].astype(np.int64)
            size, single = state["size"].to_numpy(), state["single"].to_numpy()
            value = docs["tfs"].combine_chunks().flatten().to_numpy()[found]
            sums = _row_sums(at[found], value / size[at[found]], _matrix(known["r"], width), place, len(docs))
            projected = sums + single[:, None] * (_matrix(state["y"], width) @ turn)
            return pa.table([docs["_block"], docs[key], _lists(projected), *[state[c] for c in ("size", "single", "alone")]], ["_block", key, "p", "size", "single", "alone"])

        return run

    def lone_directions(docs: pa.Table, state: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table([pa.array([], pa.string()), pa.array([], pa.list_(pa.float64()))], ["term", "z"])
        state, (at, term, begin) = aligned(docs, state), _at(docs["terms"])
        mask = lone(state, begin, len(at))
        value = (docs["tfs"].combine_chunks().flatten().to_numpy() / state["size"].to_numpy()[at])[mask] * single_idf
        return pa.table([term.filter(pa.array(mask)), _lists(value[:, None] * _matrix(state["y"], width)[at[mask]])], ["term", "z"])

    state_of = f"_block int, {shown}, p array<double>, size double, single double, alone array<int>"
    initial = terms.select("term", "n", "idf", "blocks", start.alias("q"))
    turn = orthonormal(gram(initial, "q"))
    directions = initial.select("term", _combined("q", turn).alias("q"))
    sent = initial.select(F.explode("blocks").alias("_block"), "term", "n", "idf", _combined("q", turn).alias("q"))
    state = stage(beside(sent, first, state_of), "projected")
    residual = 0.0
    for _ in range(max_rounds):
        n, *means = state.agg(F.count("*"), *[F.coalesce(F.avg(F.col("p")[i]), F.lit(0.0)) for i in range(width)]).first()
        centred = F.expr("array(" + ", ".join(f"p[{i}] - {float(m)!r}D" for i, m in enumerate(means)) + ")")
        points = state.select("_block", key, centred.alias("y"), "size", "single", "alone")
        summed = beside(points, term_sums, "term string, s array<double>").groupBy("term").agg(*[F.sum(F.col("s")[i]).alias(f"_{i}") for i in range(width)])
        image = summed.join(terms.filter("n > 1").select("term", "idf", "blocks"), "term")
        image = stage(image.select("term", "idf", "blocks", F.array(*[F.col("idf") * F.col(f"_{i}") for i in range(width)]).alias("z")), "images")
        inner, outer = gram(points, "y"), gram(image, "z") + gram(points, "y", "single")
        found, axes = np.linalg.eigh((inner + inner.T) / 2)
        found, axes = np.maximum(found[::-1], 0.0), axes[:, ::-1]
        # |C v - l v|^2 = v' C C v - l^2 for a direction v of length 1 with v' C v = l
        spare = [max(axes[:, i] @ outer @ axes[:, i] - found[i] ** 2, 0.0) ** 0.5 / found[i] if found[i] > 1e-12 else 0.0 for i in (0, 1)]
        residual = max(spare)
        if residual < tol:
            break
        turn = orthonormal(outer)
        singles = beside(points, lone_directions, "term string, z array<double>")
        directions = image.select("term", "z").unionByName(singles).select("term", _combined("z", turn).alias("q"))
        known = image.select(F.explode("blocks").alias("_block"), "term", _combined("z", turn).alias("q"), "idf")
        known = known.select("_block", "term", F.transform("q", lambda x: x * F.col("idf")).alias("r"), F.array().cast("array<int>").alias("alone"))
        # no array is null: null lists are slow to send
        held = points.withColumnRenamed("y", "r")
        state = stage(beside(known.unionByName(held, allowMissingColumns=True), project(turn), state_of), "projected")
    else:
        raise RuntimeError(f"the components still move by {residual:.1e} after {max_rounds} rounds")
    pair = axes[:, :2] * (found[:2] > 1e-12)
    turned = directions.select("term", _combined("q", pair).alias("c"))
    heads = turned.agg(*[F.max_by(F.col("c")[i], F.struct(F.abs(F.col("c")[i]), F.col("term"))).alias(f"_{i}") for i in (0, 1)]).first()
    pair = pair * np.array([-1.0 if (h or 0.0) < 0 else 1.0 for h in heads])
    place = _combined("y", pair)
    return Projection(
        points.select(key, place[0].alias("x"), place[1].alias("y")), directions.select("term", _combined("q", pair).alias("c")).select("term", F.col("c")[0].alias("x"), F.col("c")[1].alias("y")),
        [float(x) / max(n - 1, 1) for x in found[:2]], residual,
    )


def as_pipeline(*steps) -> Pipeline:
    return Pipeline(stages=list(steps))
