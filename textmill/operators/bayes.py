"""Multinomial naive Bayes as joins and aggregates: single label, one-vs-rest, and cumulative mini-batches.

A fitted model is a table with one row per vocabulary term and one weight per class column, plus one intercept per
class. The vocabulary may be of any size: documents are scored in blocks, each of which is given the weights of its own
terms once (:func:`features.weigh`), so no row per token is moved, neither for the norms of the fit nor for the scores.
Term counts are packed, one row per document; long ones are packed first.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.literals import literal_list, sql_array, sql_literal
from textmill.functions.numeric import bind_once
from textmill.operators import aggregates, features
from textmill.operators.ranking import null_safe_join
from textmill.staging import stage

ALPHA_FLOOR = 1e-10
# test rows that one task scores at most, and cells of the matrix of their frequent terms
TEST_ROWS, DENSE_CELLS = 50_000, 1 << 24
# number of terms that count as tokens only, beside those of the terms
TOKENS = -1
# class columns per aggregate
WIDE = 200
NORMS = ("l1", "l2")


@dataclass
class LinearModel:
    """Weights (term, idf, weights array<double>) and one intercept per class column."""

    weights: DataFrame
    classes: list
    intercepts: list[float]
    kind: str
    norm: str | None = "l2"
    params: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        spark = self.weights.sparkSession
        self.weights.write.mode("errorifexists").parquet(f"{path}/weights")
        meta = {
            "classes": self.classes, "intercepts": self.intercepts, "kind": self.kind, "norm": self.norm,
            "params": self.params,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(weights=spark.read.parquet(f"{path}/weights"), **meta)

    def class_weights(self) -> DataFrame:
        """Long form (term, label, weight)."""
        labels = literal_list(str(c) for c in self.classes)
        pairs = F.explode(F.arrays_zip(labels.alias("label"), F.col("weights").alias("weight"))).alias("pair")
        return self.weights.select("term", pairs).select("term", "pair.label", "pair.weight")


def distinct_labels(df: DataFrame, label: str) -> list[tuple[str, int]]:
    """Labels with their row counts, in alphabetical order: the class axis of a model."""
    return [(r[0], r[1]) for r in df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).collect()]


def class_sums(values: DataFrame, members: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(term, total, sums array): summed value per term over all rows and over the rows of each class.

    ``members`` are SQL conditions, one per class, over the columns named in ``by``. Rows are summed per (term, by...)
    first, so the conditions run on that small table and a frequent term of a frequent class is combined before the
    shuffle.
    """
    grouped = values.filter(F.col("value").isNotNull()).groupBy("term", *by).agg(F.sum("value").alias("value"))
    if len(members) > WIDE:
        grouped = stage(grouped, "class-terms")
    total = F.sum("value").alias("total")
    parts = [
        grouped.groupBy("term").agg(total, F.expr(_array_of(f"coalesce(sum(CASE WHEN {m} THEN value END), 0D)" for m in part)).alias("sums"))
        for part in _chunks(members)
    ]
    sums = parts[0]
    for part in parts[1:]:
        more = part.select("term", F.col("sums").alias("more"))
        sums = sums.join(more, "term").select("term", "total", F.concat("sums", "more").alias("sums"))
    return sums


def term_values(counts: DataFrame, vocab: DataFrame, by: Sequence[str], norm: str | None, key: str) -> DataFrame:
    """(term, by..., value): normalised tf * idf of packed counts, summed over the documents with the same ``by``.

    Without a norm the idf of a term is a factor of its sum, so it is applied to the sums.
    """
    if norm in NORMS:
        return features.normalised_sums(counts, vocab, by, norm, key)
    if norm not in (None, "None"):
        raise ValueError(f"unknown norm {norm!r}")
    summed = features.unpacked(counts.select(*by, "terms", "tfs")).groupBy("term", *by).agg(F.sum(F.col("tf").cast("double")).alias("value"))
    return summed.join(vocab.select("term", "idf"), "term").select("term", *by, (F.col("value") * F.col("idf")).alias("value"))


def _array_of(items: Iterable[str]) -> str:
    return f"array({', '.join(items)})"


def _chunks(items: Sequence, size: int | None = None) -> list[Sequence]:
    """Cut a class axis so that one aggregate never has more than ``WIDE`` class columns."""
    size = size or WIDE
    return [items[i : i + size] for i in range(0, len(items), size)]


def _column_totals(sums: DataFrame, n: int) -> tuple[int, float, list[float]]:
    """Vocabulary size, sum of all values, and sum per class."""
    per_class = F.expr(_array_of(f"sum(sums[{i}])" for i in range(n)))
    size, total, totals = sums.agg(F.count("*"), F.sum("total"), per_class).first()
    return size, total or 0.0, [x or 0.0 for x in totals]


def _weight_table(sums: DataFrame, vocab: DataFrame, weights: str, name: str) -> DataFrame:
    table = sums.join(vocab.select("term", "idf"), "term")
    return stage(table.select("term", "idf", F.expr(weights).alias("weights")), name)


def fit_from_sums(
    sums: DataFrame, vocab: DataFrame, classes: list, class_docs: list[int], alpha: float, norm: str | None
) -> LinearModel:
    """Multinomial model from per-class sums: ln((S_tc + a) / (S_c + a V)), prior ln(n_c / N)."""
    alpha = max(alpha, ALPHA_FLOOR)
    size, _, totals = _column_totals(sums, len(classes))
    n_docs = sum(class_docs)
    rest = sql_array([t + alpha * size for t in totals])
    weights = f"zip_with(sums, {rest}, (s, d) -> ln((s + {sql_literal(float(alpha))}) / d))"
    priors = [math.log(n / n_docs) if n else float("-inf") for n in class_docs]
    table = _weight_table(sums, vocab, weights, "bayes")
    return LinearModel(table, classes, priors, "multinomial", norm, {"alpha": alpha})


def fit_nb(
    counts: DataFrame,
    docs: DataFrame,
    label: str = "label",
    key: str = "id",
    alpha: float = 1.0,
    norm: str | None = "l2",
    use_idf: bool = True,
    vocab: DataFrame | None = None,
    **vocab_params,
) -> LinearModel:
    """Fit on staged term counts, packed or (key, label, term, tf), and the documents (key, label) they come from.

    Documents without a label teach nothing and are left out.
    """
    counts, docs = counts.filter(F.col(label).isNotNull()), docs.filter(F.col(label).isNotNull())
    labels = distinct_labels(docs, label)
    n_docs = sum(n for _, n in labels)
    counts = features.packed(counts)
    if vocab is None:
        vocab = stage(features.fit_vocab(features.unpacked(counts), key=key, n_docs=F.lit(n_docs), **vocab_params), "vocab")
    if not use_idf:
        vocab = vocab.withColumn("idf", F.lit(1.0))
    values = term_values(counts, vocab, [label], norm, key)
    members = [f"`{label}` = {sql_literal(name)}" for name, _ in labels]
    sums = stage(class_sums(values, members, [label]), "class-sums")
    return fit_from_sums(sums, vocab, [name for name, _ in labels], [n for _, n in labels], alpha, norm)


def fit_ovr_nb(
    counts: DataFrame,
    docs: DataFrame,
    labels: Sequence[str],
    tags: str = "tags",
    key: str = "id",
    alpha: float = 1.0,
    norm: str | None = "l2",
    **vocab_params,
) -> LinearModel:
    """One binary model per label, all fitted in one pass: positive sums by tag, negative sums as total minus positive."""
    alpha = max(alpha, ALPHA_FLOOR)
    members = [f"array_contains(`{tags}`, {sql_literal(label)})" for label in labels]
    n_docs, positives = docs.agg(
        F.count("*"), F.expr(_array_of(f"count_if({m})" for m in members))
    ).first()
    counts = features.packed(counts)
    vocab = stage(features.fit_vocab(features.unpacked(counts), key=key, n_docs=F.lit(n_docs), **vocab_params), "vocab")
    values = term_values(counts, vocab, [tags], norm, key)
    sums = stage(class_sums(values, members, [tags]), "class-sums")
    size, total, totals = _column_totals(sums, len(labels))
    a = sql_literal(float(alpha))
    inside = f"zip_with(sums, {sql_array([t + alpha * size for t in totals])}, (s, d) -> ln((s + {a}) / d))"
    outside = f"zip_with(sums, {sql_array([total - t + alpha * size for t in totals])}, (s, d) -> ln((total - s + {a}) / d))"
    table = _weight_table(sums, vocab, f"zip_with({inside}, {outside}, (p, q) -> p - q)", "bayes-ovr")
    return LinearModel(table, list(labels), [_log_odds(n, n_docs) for n in positives], "one-vs-rest", norm, {"alpha": alpha})


def _log_odds(n: int, n_docs: int) -> float:
    """Prior log odds; a label carried by no document never wins, one carried by all always does."""
    if n in (0, n_docs):
        return float("-inf") if n == 0 else float("inf")
    return math.log(n / n_docs) - math.log((n_docs - n) / n_docs)


def linear_scores(counts: DataFrame, model: LinearModel, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., scores array<double>): one score per class for every document, also for those without known terms."""
    weighed = features.weigh(features.packed(counts), model.weights, key, len(model.classes))
    parts = ", ".join(f"sum(sums[{i}])" for i in range(len(model.classes)))
    size = {"l1": "sum(absolute)", "l2": "sqrt(sum(squares))"}.get(model.norm, "1D")
    # the row norm divides the sums, so the rows need not be scaled before they are summed
    summed = weighed.groupBy(key, *keep).agg(F.expr(f"array({parts})").alias("sums"), F.expr(size).alias("size"))
    scores = f"zip_with(sums, {sql_array(model.intercepts)}, (s, b) -> coalesce(s / nullif(size, 0D), 0D) + b)"
    return summed.select(key, *keep, F.expr(scores).alias("scores"))


def argmax_label(scores: Column, classes: Sequence) -> Column:
    """Class of the largest score; among equals the first class."""
    return F.element_at(literal_list(classes), F.array_position(scores, F.array_max(scores)).cast("int"))


def softmax(scores: Column) -> Column:
    """Scores to probabilities, shifted by the largest score."""
    shifted = bind_once(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b)
    return bind_once(F.struct(shifted.alias("e"), total.alias("t")), lambda v: F.transform(v["e"], lambda e: e / v["t"]))


def predict_nb(counts: DataFrame, model: LinearModel, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted, scores)."""
    scored = linear_scores(counts, model, key, keep)
    return scored.select(key, *keep, argmax_label(F.col("scores"), model.classes).alias("predicted"), "scores")


def predict_label(counts: DataFrame, model: LinearModel, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted) for any number of classes.

    A long class axis, such as one class per tag set, is scored slice by slice; the winner of every slice competes for the
    row, so no row ever carries all scores.
    """
    winners = []
    for places in _chunks(range(len(model.classes))):
        part = replace(
            model,
            weights=model.weights.withColumn("weights", F.slice("weights", places[0] + 1, len(places))),
            classes=[model.classes[i] for i in places],
            intercepts=[model.intercepts[i] for i in places],
        )
        best = predict_nb(counts, part, key, keep).withColumn("top", F.array_max("scores")).drop("scores")
        winners.append(best)
    if len(winners) == 1:
        return winners[0].drop("top")
    every = reduce(DataFrame.unionByName, winners)
    first = F.min_by("predicted", F.struct(-F.col("top"), F.col("predicted")))
    return every.groupBy(key, *keep).agg(first.alias("predicted"))


def predict_proba(counts: DataFrame, model: LinearModel, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted, probability array in class order)."""
    scored = predict_nb(counts, model, key, keep)
    return scored.select(key, *keep, "predicted", softmax(F.col("scores")).alias("probability"))


def long_probabilities(probs: DataFrame, classes: Sequence[str], name: str, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., model, label, p) from the array form."""
    labels = literal_list(classes)
    pair = F.explode(F.arrays_zip(labels.alias("label"), F.col("probability").alias("p"))).alias("pair")
    return probs.select(key, *keep, F.lit(name).alias("model"), pair).select(key, *keep, "model", "pair.label", "pair.p")


def predict_ovr(counts: DataFrame, model: LinearModel, key: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., predicted array): the labels whose positive class wins."""
    scored = linear_scores(counts, model, key, keep)
    names = literal_list(model.classes)
    zipped = F.arrays_zip(names.alias("label"), F.col("scores").alias("score"))
    hits = F.transform(F.filter(zipped, lambda z: z["score"] > 0), lambda z: z["label"])
    return scored.select(key, *keep, hits.alias("predicted"))


def _coded_rows(names: list, label: str, batch: str, whole: bool):
    """(batch, cls, cells, tokens, docs): numbers and frequencies of the known terms of each row, as bytes, and its other tokens.

    ``whole``: every term is in the vocabulary, so those without a row in ``known`` count as tokens too.
    """

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        lists, kind = rows["terms"].combine_chunks(), rows.schema.field(label).type
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        cls = pc.index_in(rows[label].combine_chunks(), value_set=pa.array(names, kind)).cast(pa.int64())
        place = pc.index_in(lists.flatten(), value_set=known["term"].combine_chunks())
        idx = np.full(len(place), TOKENS)
        found = place.is_valid().to_numpy(zero_copy_only=False)
        idx[found] = known["idx"].to_numpy()[pc.fill_null(place, 0).to_numpy()[found]]
        tf = rows["tfs"].combine_chunks().flatten().to_numpy()
        others = np.concatenate([[0], np.cumsum(np.where((idx < 0) & (found | whole), tf, 0))])
        cells = []
        for begin, end in zip(ends[:-1], ends[1:], strict=True):
            at = begin + np.flatnonzero(idx[begin:end] >= 0)
            cells.append(features.planes(idx[at]) + features.planes(tf[at]))
        columns = [rows[batch].combine_chunks().cast(pa.int64()), cls, pa.array(cells, pa.binary()), pa.array(others[ends[1:]] - others[ends[:-1]])]
        return pa.table([*columns, pa.array(np.zeros(len(rows), dtype=np.int64))], ["batch", "cls", "cells", "tokens", "docs"])

    return run


def _packed_batch(n_classes: int):
    """The rows (batch, cls, cells, tokens, docs) of one batch as one row: counts per (class, known term) as bytes, documents and tokens per class."""

    def run(rows: pa.Table) -> pa.Table:
        of_row, cells = rows["cls"].to_numpy(), rows["cells"].to_pylist()
        held = [len(c) // 8 for c in cells]
        idx, tf = features.numbers([c[: 4 * n] for c, n in zip(cells, held, strict=True)]), features.numbers([c[4 * n :] for c, n in zip(cells, held, strict=True)])
        cls = np.repeat(of_row, held)
        docs = np.bincount(of_row, weights=rows["docs"].to_numpy(), minlength=n_classes)
        tokens = np.bincount(of_row, weights=rows["tokens"].to_numpy(), minlength=n_classes) + np.bincount(cls, weights=tf, minlength=n_classes)
        # by class, then by term
        width = int(idx.max()) + 1 if len(idx) else 1
        found, where = np.unique(cls * width + idx, return_inverse=True)
        add = np.bincount(where, weights=tf, minlength=len(found))
        ends = np.cumsum(np.bincount(found // width, minlength=n_classes))
        steps = np.diff(found, prepend=0)  # smaller than the numbers, so they take less room
        columns = [pa.array([_squeezed(x.astype(np.int64))], pa.binary()) for x in (steps, ends, add)]
        return pa.table([rows["batch"].slice(0, 1), pa.array([width]), *columns, *[pa.array([x.astype(np.int64)]) for x in (docs, tokens)]], ["batch", "width", "idx", "ends", "tf", "docs", "tokens"])

    return run


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: the bytes of one place together, compressed."""
    return zlib.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _loosened(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T).view("<i8").ravel()


class _Judge:
    """Scores of a share of the test rows under the running model, and right answers after each batch."""

    def __init__(self, tests: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, vocabulary: int, alpha: float):
        self.n_classes, self.vocabulary, self.alpha, self.size = n_classes, vocabulary, alpha, len(tests)
        self.label = np.array([t[0] for t in tests], dtype=np.int64)
        self.known = np.array([t[2].sum() for t in tests], dtype=np.float64)
        rows = np.repeat(np.arange(self.size), [len(t[1]) for t in tests])
        terms, tf = (np.concatenate([t[i] for t in tests]) if tests else np.zeros(0, dtype=np.int64) for i in (1, 2))
        self.terms, held = np.unique(terms, return_counts=True)
        code = np.searchsorted(self.terms, terms)
        # terms of many rows as a matrix of bounded size, the others by their lists
        often = np.argsort(-held, kind="stable")[: DENSE_CELLS // max(self.size, 1)]
        often = often[held[often] >= max(8, self.size // 64)]
        self.place = np.full(len(self.terms), -1)
        self.place[often] = np.arange(len(often))
        at = self.place[code] >= 0
        self.matrix = np.zeros((self.size, len(often)))
        np.add.at(self.matrix, (rows[at], self.place[code[at]]), tf[at])
        order = np.argsort(code[~at], kind="stable")
        self.rows, self.tf = rows[~at][order], tf[~at][order].astype(np.float64)
        held = np.bincount(code[~at], minlength=len(self.terms))
        self.starts, self.held = np.cumsum(held) - held, held
        self.counts = np.zeros((len(self.terms), n_classes), dtype=np.int64)
        self.scores, self.docs, self.tokens = np.zeros((self.size, n_classes)), np.zeros(n_classes), np.zeros(n_classes)

    def judge(self, batches: list[tuple]) -> list[tuple[int, int, int]]:
        """(batch, n_train, right) after each of a few batches; what they change is multiplied with the test rows at once."""
        width = len(batches) * self.n_classes
        changes = np.zeros((self.matrix.shape[1], width))
        gained = np.zeros((self.size, width))
        for number, (_, idx, ends, add, _, _) in enumerate(batches):
            cls = np.repeat(np.arange(self.n_classes), np.diff(ends, prepend=0))
            code = np.searchsorted(self.terms, idx)
            here = np.flatnonzero(code < len(self.terms))
            here = here[self.terms[code[here]] == idx[here]]
            code, cls, add = code[here], cls[here], add[here]
            before = self.counts[code, cls]
            self.counts[code, cls] = before + add  # a batch has one cell per (term, class)
            change = np.log(before + add + self.alpha) - np.log(before + self.alpha)
            column, place = number * self.n_classes + cls, self.place[code]
            changes[place[place >= 0], column[place >= 0]] = change[place >= 0]
            # every other changed weight goes to the test rows that hold its term
            held = self.held[code]
            which = np.repeat(np.arange(len(held)), held)
            at = np.arange(len(which)) + np.repeat(self.starts[code] - (np.cumsum(held) - held), held)
            goal = self.rows[at] * self.n_classes + cls[which]
            gained[:, number * self.n_classes : (number + 1) * self.n_classes] = np.bincount(goal, weights=self.tf[at] * change[which], minlength=self.scores.size).reshape(self.scores.shape)
        gained += self.matrix @ changes
        found = []
        for number, (batch, _, _, _, docs, tokens) in enumerate(batches):
            self.scores += gained[:, number * self.n_classes : (number + 1) * self.n_classes]
            self.docs, self.tokens = self.docs + docs, self.tokens + tokens
            with np.errstate(divide="ignore"):
                whole = self.scores + np.log(self.docs / self.docs.sum()) - self.known[:, None] * np.log(self.tokens + self.alpha * self.vocabulary)
            right = int((whole.argmax(axis=1) == self.label).sum()) if self.size else 0
            found.append((int(batch), int(self.docs.sum()), right))
        return found


def _judged(n_classes: int, vocabulary: int, alpha: float):
    """Right answers after each batch for the shares of a partition, whose rows come as its test rows and then its batches in order."""
    together = max(1, WIDE // n_classes)

    def run(tables: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        current, tests, judge, waiting = None, [], None, []

        def out(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(x, pa.int64()) for x in (zip(*found, strict=True) if found else ((), (), ()))], ["batch", "n_train", "right"])

        for table in tables:
            share, turn, batch = (table.column(name).to_numpy(zero_copy_only=False) for name in ("share", "turn", "batch"))
            packed, lists = [table.column(name) for name in ("idx", "ends", "tf")], [table.column(name) for name in ("docs", "tokens")]
            for i in range(len(share)):
                if share[i] != current:
                    if waiting:
                        yield out(judge.judge(waiting))
                    current, tests, judge, waiting = share[i], [], None, []
                idx, ends, tf = (_loosened(x[i].as_py()) for x in packed)
                if turn[i] == 0:
                    tests.append((int(ends[0]), idx, tf))
                    continue
                idx = np.cumsum(idx) % table.column("width")[i].as_py()
                docs, tokens = (x[i].values.to_numpy() for x in lists)
                if judge is None:
                    judge, tests = _Judge(tests, n_classes, vocabulary, alpha), []
                waiting.append((batch[i], idx, ends, tf, docs, tokens))
                if len(waiting) == together:
                    yield out(judge.judge(waiting))
                    waiting = []
        if waiting:
            yield out(judge.judge(waiting))

    return run


_SHARED = "share int, turn int, batch bigint, width bigint, idx binary, ends binary, tf binary, docs array<bigint>, tokens array<bigint>"


def _test_rows(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Test rows (share, cls, idx, tf) in the form of the batches, their class in place of the ends."""
    for rows in batches:
        none, n = pa.nulls(len(rows), pa.int64()), len(rows)
        idx, tf = ([_squeezed(x.values.to_numpy()) for x in rows.column(name)] for name in ("idx", "tf"))
        cls = [_squeezed(np.array([c])) for c in rows.column("cls").to_pylist()]
        empty = pa.nulls(n, pa.list_(pa.int64()))
        columns = [rows.column("share"), pa.array(np.zeros(n, dtype=np.int32)), none, none, *(pa.array(x, pa.binary()) for x in (idx, cls, tf)), empty, empty]
        yield pa.record_batch(columns, ["share", "turn", "batch", "width", "idx", "ends", "tf", "docs", "tokens"])


def prequential(
    train_counts: DataFrame,
    train_docs: DataFrame,
    test_counts: DataFrame,
    n_test: int,
    batch: str = "batch",
    label: str = "label",
    key: str = "id",
    alpha: float = 1.0,
    blocks: int | None = None,
    **vocab_params,
) -> DataFrame:
    """(batch, n_train, accuracy): the model after each mini-batch, judged on one fixed test set; any number of batches.

    Counts are packed, one row per document, or long. They are additive, so the weight of a (term, class) only changes in batches
    that hold it. The terms of the training rows get their numbers in blocks of rows (those of a column ``_block`` written as
    ``blocks`` buckets stay where they lie), so only numbers are moved to the batches. A batch is one row: its counts per (class,
    term) of the terms that the test set knows, and its documents and tokens per class. The test rows are cut into one share per
    task slot, more where ``TEST_ROWS`` is passed. A task reads its share, then the batches in order, and adds what each changes
    to the scores of its rows: it holds its share and a few batches, and what is moved are the test rows once and the batches, as
    compressed bytes, once per share. Documents without a label teach nothing.
    """
    alpha = max(alpha, ALPHA_FLOOR)
    spark = train_docs.sparkSession
    train_counts, train_docs = train_counts.filter(F.col(label).isNotNull()), train_docs.filter(F.col(label).isNotNull())
    train_counts, test_counts = features.packed(train_counts), features.packed(test_counts)
    classes = stage(aggregates.index_labels(train_docs, label).select(F.col("label").alias("_label"), F.col("label_index").cast("bigint").alias("cls")), "classes")
    n_classes, n_docs = classes.count(), train_docs.count()
    vocab = stage(features.fit_vocab(features.unpacked(train_counts), key=key, n_docs=F.lit(n_docs), **vocab_params).select("term"), "vocab")
    size = vocab.count()
    # terms that no test row holds count as tokens only
    asked = features.index_vocab(vocab.join(features.unpacked(test_counts).select("term").distinct(), "term"))
    vocab = stage(vocab.join(asked, "term", "left").select("term", F.coalesce(F.col("idx").cast("int"), F.lit(TOKENS)).alias("idx")), "vocab")

    def coded(rows: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(classes, F.col(label) == F.col("_label"), how)

    if "_block" not in train_counts.columns:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        number = F.pmod(F.xxhash64(key), F.lit(max(parts, -(-n_docs // features.BLOCK_DOCS)))).cast("int")
        train_counts, blocks = train_counts.withColumn("_block", number).repartition(parts, "_block"), parts
    whole = not vocab_params
    wanted = vocab.filter("idx >= 0") if whole else vocab
    known = train_counts.select(F.col("_block").alias("_block"), F.explode("terms").alias("term")).distinct().join(wanted, "term").select("_block", "term", "idx")
    names = [r["_label"] for r in classes.orderBy("cls").collect()]
    kind = "batch bigint, cls bigint, cells binary, tokens bigint, docs bigint"
    sides = train_counts.select("_block", label, batch, "terms", "tfs").groupBy("_block"), known.repartition(blocks, "_block").groupBy("_block")
    words = sides[0].cogroup(sides[1]).applyInArrow(_coded_rows(names, label, batch, whole), kind)
    docs = coded(train_docs).groupBy(F.col(batch).cast("bigint").alias("batch"), "cls").agg(F.count("*").alias("docs"))
    docs = docs.select("batch", "cls", F.lit(b"").alias("cells"), F.lit(0).cast("bigint").alias("tokens"), "docs")
    kind = "batch bigint, width bigint, idx binary, ends binary, tf binary, docs array<bigint>, tokens array<bigint>"
    batches = stage(words.unionByName(docs).groupBy("batch").applyInArrow(_packed_batch(n_classes), kind), "batch-cells")

    held = features.unpacked(test_counts.select(key, "terms", "tfs")).join(vocab.filter("idx >= 0"), "term")
    held = held.groupBy(key).agg(F.collect_list(F.struct("idx", F.col("tf").cast("bigint").alias("tf"))).alias("entries"))
    tests = coded(test_counts.select(key, label), "left").groupBy(key).agg(F.coalesce(F.max("cls"), F.lit(-1).cast("bigint")).alias("cls"))
    none = F.array().cast("array<struct<idx:int,tf:bigint>>")
    tests = null_safe_join(tests, held, [key], "left").select(F.col(key).alias("_key"), "cls", F.coalesce("entries", none).alias("entries"))

    shares = max(spark.sparkContext.defaultParallelism, -(-n_test // TEST_ROWS))
    share = F.pmod(F.xxhash64("_key"), F.lit(shares)).cast("int").alias("share")
    first = tests.select(share, "cls", F.col("entries.idx").alias("idx"), F.col("entries.tf").alias("tf")).mapInArrow(_test_rows, _SHARED)
    every = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")
    then = batches.select(every, F.lit(1).alias("turn"), "batch", "width", "idx", "ends", "tf", "docs", "tokens")
    # one partition a share
    dealt = first.unionByName(then).repartitionById(shares, F.col("share")).sortWithinPartitions("share", "turn", "batch")
    judged = dealt.mapInArrow(_judged(n_classes, size, alpha), "batch bigint, n_train bigint, right bigint")
    summary = judged.groupBy("batch").agg(F.max("n_train").alias("n_train"), F.sum("right").alias("right"))
    return summary.select("batch", "n_train", (F.col("right") / F.lit(n_test)).alias("accuracy"))
