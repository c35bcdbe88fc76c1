"""Joins by inverted index and running counts, against plain loops."""

import glob
import math
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textmill.operators import aggregates, bayes, features, knn
from textmill.operators.ranking import global_rank
from textmill.staging import checkpoint_root


def packed(spark, rows):
    """rows: (id, tags, {term: weight})"""
    # the frequency tells vectors apart, as it does for weights that are frequency times idf
    long = [(i, tags, t, int(10 * w) if t else None, w) for i, tags, vector in rows for t, w in (vector or {None: None}).items()]
    return knn.pack_vectors(spark.createDataFrame(long, "id long, tags array<string>, term string, tf long, value double"), "id", ["tags"])


def plain_lists(train, query, k):
    def unit(v):
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    sims = []
    for i, _, vector in train:
        a, b = unit(vector), unit(query)
        sims.append((-round(sum(x * b.get(t, 0.0) for t, x in a.items()), 9), i))
    return [i for _, i in sorted(sims)[: k + 1]]


@pytest.mark.parametrize("block_rows", [3, 40])
def test_neighbours_of_disjoint_and_empty_vectors(spark, block_rows):
    """Topics without common terms, vectors without terms, many equal vectors, and frequent terms."""
    rng = random.Random(6)
    rows = []
    for i in range(120):
        topic = rng.choice("abcde")
        vector = {f"{topic}{rng.randint(0, 9)}": rng.choice([0.5, 1.0, 2.0]) for _ in range(rng.randint(0, 5))}
        if vector and i % 3 == 0:
            vector["common"] = 0.3
        rows.append((1_000 - i, ["x"], vector))
    rows += [(2_000 + i, ["y"], {"e1": 1.0, "common": 5.0}) for i in range(30)]
    train = [r for r in rows if r[0] % 5]
    queries, reference = packed(spark, rows), packed(spark, train)
    lists = {r.signature: [n.neighbour for n in r.best] for r in knn.neighbour_lists(queries, reference, 2, block_rows=block_rows).collect()}
    vectors = {i: vector for i, _, vector in rows}
    for r in queries.select("id", "signature").collect():
        assert lists[r.signature] == plain_lists(train, vectors[r.id], 2), vectors[r.id]


def test_few_training_rows(spark):
    one = packed(spark, [(1, ["x"], {"a": 1.0})])
    more = packed(spark, [(5, ["x"], {"b": 1.0}), (6, ["x"], {"a": 2.0}), (7, ["x"], {})])
    assert all([n.neighbour for n in r.best] == [1] for r in knn.neighbour_lists(more, one, 3).collect())


def plain_history(train, test, alpha):
    """train: (batch, label, terms) in order; test: (label, terms)."""
    vocabulary = {t for _, _, terms in train for t in terms}
    classes, out = sorted({label for _, label, _ in train}), []
    docs, words = Counter(), defaultdict(Counter)
    for batch in sorted({b for b, _, _ in train}):
        for _, label, terms in (r for r in train if r[0] == batch):
            docs[label] += 1
            words[label].update(terms)
        right = 0
        for label, terms in test:
            scores = []
            for c in classes:
                total = sum(words[c].values())
                s = math.log(docs[c] / sum(docs.values())) if docs[c] else -math.inf
                s += sum(math.log((words[c][t] + alpha) / (total + alpha * len(vocabulary))) for t in terms if t in vocabulary)
                scores.append(s)
            right += classes[max(range(len(classes)), key=lambda j: (scores[j], -j))] == label
        out.append((batch, sum(docs.values()), right / len(test)))
    return out


@pytest.mark.parametrize("n_batches, n_classes", [(1, 3), (50, 6)])
def test_history_of_many_batches(spark, n_batches, n_classes):
    rng = random.Random(n_batches)
    words = [f"w{i}" for i in range(40)]

    def text(label):
        return [rng.choice(words[label * 4 : label * 4 + 12] if rng.random() < 0.5 else words) for _ in range(rng.randint(0, 8))]

    train, test = [], []
    for b in range(n_batches):
        for _ in range(5):
            label = rng.randrange(n_classes) if b > 3 else rng.randrange(2)
            train.append((b, f"c{label}", text(label)))
    for _ in range(60):
        label = rng.randrange(n_classes)
        test.append((f"c{label}" if rng.random() < 0.9 else "unseen", text(label) + ["never"]))

    def counts(rows, schema):
        return spark.createDataFrame([(*head, t, n) for *head, terms in rows for t, n in (Counter(terms) or {None: 1}).items()], schema)

    train_rows = [(i, label, b, terms) for i, (b, label, terms) in enumerate(train)]
    docs = spark.createDataFrame([r[:3] for r in train_rows], "id long, label string, batch long")
    test_counts = counts([(i, label, terms) for i, (label, terms) in enumerate(test)], "id long, label string, term string, tf long")
    got = bayes.prequential(counts(train_rows, "id long, label string, batch long, term string, tf long"), docs, test_counts, len(test)).orderBy("batch").collect()
    assert [(r.batch, r.n_train, pytest.approx(r.accuracy)) for r in got] == plain_history(train, test, 1.0)


def test_five_thousand_labels_are_indexed(spark):
    names = [f"label {i:05d}" for i in range(5_000)]
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "label string").repartition(6)
    got = {r.label: r.label_index for r in aggregates.index_labels(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_ranks_of_ties_and_nothing(spark):
    df = spark.range(1_000).select((F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("b"))
    rows = global_rank(df, ["a"], "place", 5).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(1_000)) and [r.a for r in rows] == sorted(r.a for r in rows)
    assert global_rank(df.filter("false"), ["a"]).collect() == []
    vocab = features.index_vocab(df.select(F.col("b").alias("term")).distinct())
    assert [r.term for r in vocab.orderBy("idx").collect()] == sorted(str(i) for i in range(1_000))


def test_history_writes_rows_in_proportion_to_its_input(spark):
    """Twice the batches and twice the test rows are twice the rows written, not four times."""
    folder = f"{checkpoint_root(spark)}/textmill/{spark.sparkContext.applicationId}"

    def written():
        return sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{folder}/*/*.parquet"))

    def history_rows(n):
        rows = [(i, f"c{i % 3}", i, [f"w{i % 7}", f"w{i % 11}"], [1, 2]) for i in range(n)]
        train = spark.createDataFrame(rows, "id long, label string, batch long, terms array<string>, tfs array<long>")
        test, before = train.filter("id % 2 = 0").drop("batch").select("id", "label", F.explode(F.arrays_zip("terms", "tfs")).alias("e")), written()
        test = test.groupBy("id", "label", F.col("e.terms").alias("term")).agg(F.sum("e.tfs").alias("tf"))
        long = train.select("id", "label", "batch", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("id", "label", "batch", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))
        assert bayes.prequential(long, train.select("id", "label", "batch"), test, n // 2).count() == n
        return written() - before

    assert history_rows(480) < 2.5 * history_rows(240)
