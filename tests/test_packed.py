"""Packed term counts and block-wise weighing against the long form."""

import math

import pytest

from textmill.operators import bayes, features
from textmill.staging import SPREAD_ROWS, spread, stage

ROWS = [(1, "a", "x y x \u00e9\u00e9"), (1, "a", "x z"), (1, "b", "x w"), (2, "b", None), (None, "a", "y y"), (3, "b", ""), (4, None, "q x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id bigint, label string, text string")


def test_packed_counts_equal_long_ones(docs):
    long = features.term_counts(features.explode_tokens(docs, "text", "id", ["label"]), "id", ["label"]).filter("term is not null")
    packed = features.count_packed(docs, "text", "id", ["label"])
    assert packed.count() == 6
    assert sorted(map(str, features.unpacked(packed).select(*long.columns).collect())) == sorted(map(str, long.collect()))


@pytest.mark.parametrize("whole", [0, 100])
def test_weigh_gives_sums_and_norms(spark, docs, monkeypatch, whole):
    monkeypatch.setattr(features, "WHOLE_TERMS", whole)
    table = spark.createDataFrame([("x", 2.0, [1.0, 10.0]), ("y", 1.0, [0.5, -1.0]), ("\u00e9\u00e9", 3.0, [0.0, 1.0])], "term string, idf double, weights array<double>")
    counts = stage(features.count_packed(docs, "text", "id", ["label"]), "counts")
    got = {(r.id, r.label): r for r in features.weigh(counts, table, "id", 2).collect()}
    assert len(got) == 6
    assert got[1, "a"].sums == pytest.approx([6.5, 62.0]) and got[1, "a"].squares == pytest.approx(36 + 1 + 9) and got[1, "a"].absolute == pytest.approx(10)
    assert got[None, "a"].sums == pytest.approx([1.0, -2.0]) and got[3, "b"].sums == [0.0, 0.0]
    sized = {(r.id, r.label): r for r in features.weigh(counts, table, "id", by_key=True).collect()}
    assert sized[1, "a"].squares == sized[1, "b"].squares == pytest.approx(46 + 4)
    assert dict(zip(sized[1, "a"].terms, sized[1, "a"].tfs, strict=True)) == {"x": 3, "y": 1, "z": 1, "\u00e9\u00e9": 1}


@pytest.mark.parametrize("norm", ["l1", "l2", None])
def test_term_values_are_sums_of_the_normalised_rows(docs, norm):
    long = stage(features.term_counts(features.explode_tokens(docs, "text", "id", ["label"]), "id", ["label"]), "counts")
    vocab = stage(features.fit_vocab(long), "vocab")
    rows = features.normalise(features.tfidf(long, vocab), norm).groupBy("term", "label").agg({"value": "sum"}).collect()
    got = {(r.term, r.label): r.value for r in bayes.term_values(features.packed(long), vocab, ["label"], norm, "id").collect()}
    assert got.keys() == {(r.term, r.label) for r in rows}
    assert all(math.isclose(got[r.term, r.label], r["sum(value)"]) for r in rows)


def test_spread_bounds_the_rows_of_a_partition(spark):
    few = spark.range(100, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(few, 1).rdd.getNumPartitions() == 1
    many = spread(spark.range(2 * SPREAD_ROWS * spark.sparkContext.defaultParallelism, numPartitions=1))
    assert max(many.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) <= 1.01 * SPREAD_ROWS


def test_class_sums_are_formed_in_the_blocks(spark):
    """No row per token leaves the tasks that find the norms."""
    docs = spark.createDataFrame([(i, f"c{i % 2}", ["a", "b"], [1, 2]) for i in range(40)], "id long, label string, terms array<string>, tfs array<long>")
    vocab = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "term string, idf double")
    summed = bayes.term_values(docs, vocab, ["label"], "l2", "id")
    assert "Generate explode(arrays_zip" not in summed._jdf.queryExecution().executedPlan().toString()
    got = {(r.term, r.label): r.value for r in summed.collect()}
    assert got == {(t, f"c{i}"): pytest.approx(20 * v / 17**0.5) for t, v in (("a", 1), ("b", 4)) for i in (0, 1)}
