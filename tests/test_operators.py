"""Operators against plain windows, brute force, pyspark.ml and their own invariants."""

import math
import random
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.errors import InvalidPoint
from textmill.functions.numeric import fingerprint
from textmill.operators import aggregates, bayes, catalog, features, graph, knn, learners, metrics, search, splits, vote
from textmill.operators.ranking import rank_within, running_totals
from textmill.plans import train
from textmill.staging import stage


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(4)
    words = {"de": "haus baum tag nacht".split(), "en": "house tree day night".split(), "xx": "tag day foo bar".split()}
    rows = []
    for i in range(90):
        label = ("de", "en", "xx")[i % 3]
        rows.append((i, label, [label, "odd" if i % 2 else "even"], " ".join(rng.choice(words[label]) for _ in range(1 + i % 7))))
    rows.append((90, "de", ["de", "even"], ""))
    return spark.createDataFrame(rows, "id bigint, label string, tags array<string>, text string")


def test_rank_within_equals_window(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"))
    plain = W.partitionBy("g").orderBy(fingerprint(F.col("id"), "s"), "id")
    want = {(r.id, r.rank) for r in df.select("id", F.row_number().over(plain).alias("rank")).collect()}
    got = {(r.id, r.rank) for r in rank_within(df, "id", ["g"], "s", digits=2).select("id", "rank").collect()}
    assert got == want


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_equal_window(spark, descending):
    df = spark.range(500).select((F.col("id") / 7).alias("s"), (F.col("id") % 5).alias("v"), (F.col("id") % 3).alias("g"))
    order = F.desc("s") if descending else F.asc("s")
    plain = W.partitionBy("g").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    want = {(r.s, r.c) for r in df.select("s", F.sum("v").over(plain).alias("c")).collect()}
    got = {(r.s, r.cum_v) for r in running_totals(df, "s", ["v"], ["g"], descending, partitions=16).collect()}
    assert got == want


def test_splits(spark):
    df = spark.range(3000).withColumn("label", F.when(F.col("id") % 10 < 9, "big").otherwise("small"))
    train_part, held = splits.hash_split(df, "id", 20)
    assert train_part.count() + held.count() == 3000
    assert train_part.join(held, "id").count() == 0
    shares = splits.stratified_split(df, "label", "id", 0.2).filter("split = 'eval'").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in shares} == {"big": 540, "small": 60}
    folds = splits.kfold(df, 3, "id", "label").groupBy("label", "fold").count().collect()
    assert {r["count"] for r in folds} == {900, 100}
    assert splits.sample(df, 1.5).count() == 3000
    assert splits.hash_sample(df, 0.0, "id").count() == 3000
    assert 0 < splits.sample(df, 0.1, 3).count() < 3000


def test_null_labels_survive_ranking(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, label string")
    assert splits.stratified_split(df, "label", "id", 0.5).count() == 3


def test_dedupe_keeps_first(spark):
    df = spark.createDataFrame([(1, "a", 9), (2, "a", 8), (3, None, 7), (4, None, 6)], "id int, k string, v int")
    assert sorted((r.id, r.v) for r in splits.dedupe(df, ["k"], "id").collect()) == [(1, 9), (3, 7)]


def counts_of(df, keep=("label",)):
    return stage(features.term_counts(features.explode_tokens(df, "text", "id", keep, "space"), "id", keep))


def test_tfidf_rows_have_unit_norm(posts):
    values = features.tfidf_vectorise(posts, "text")
    norms = values.groupBy("id").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()
    assert all(r.n == pytest.approx(1.0) for r in norms)
    totals = features.tfidf_vectorise(posts, "text", norm="l1").groupBy("id").agg(F.sum("value").alias("n")).collect()
    assert all(r.n == pytest.approx(1.0) for r in totals)


def test_vocabulary_bounds(posts):
    counts = counts_of(posts)
    everything = features.fit_vocab(counts).count()
    assert features.fit_vocab(counts, 1.0, 1.0).count() == everything
    assert features.fit_vocab(counts, max_features=3).count() == 3
    n = posts.count()
    for row in features.fit_vocab(counts, 10, 0.3).collect():
        assert 10 <= row.df <= 0.3 * n
        assert row.idf == pytest.approx(math.log((1 + n) / (1 + row.df)) + 1)


def test_naive_bayes_matches_pyspark_ml(posts):
    data = posts.filter("text <> ''")
    counts = counts_of(data)
    model = bayes.fit_nb(counts, data, alpha=0.7, norm=None, use_idf=False)
    terms = sorted(r.term for r in model.weights.select("term").collect())
    wide = counts.groupBy("id", "label").pivot("term", terms).sum("tf").fillna(0)
    indexed = wide.join(aggregates.index_labels(wide), "label").withColumn("y", F.col("label_index").cast("double"))
    vectors = VectorAssembler(inputCols=terms, outputCol="f").transform(indexed)
    theta = NaiveBayes(smoothing=0.7, featuresCol="f", labelCol="y").fit(vectors).theta.toArray()
    ours = {(r.term, r.label): r.weight for r in model.class_weights().collect()}
    for i, label in enumerate(model.classes):
        for j, term in enumerate(terms):
            assert ours[(term, label)] == pytest.approx(theta[i][j])
    # priors are plain shares
    assert model.intercepts == [pytest.approx(math.log(30 / 90))] * 3


def test_probabilities_and_empty_documents(posts):
    counts = counts_of(posts)
    model = bayes.fit_nb(counts, posts)
    rows = bayes.predict_proba(counts, model).collect()
    assert len(rows) == 91
    assert all(sum(r.probability) == pytest.approx(1.0) for r in rows)
    # no words: the largest prior wins
    assert next(r.predicted for r in rows if r.id == 90) == "de"


def test_long_class_axis_is_cut_without_change(posts, monkeypatch):
    named = posts.withColumn("label", F.concat_ws("/", "label", F.element_at("tags", 2)))
    counts = counts_of(named)
    whole = bayes.fit_nb(counts, named)
    want = {(r.id, r.predicted) for r in bayes.predict_label(counts, whole).collect()}
    monkeypatch.setattr(bayes, "WIDE", 4)
    cut = bayes.fit_nb(counts, named)
    assert len(cut.classes) == 6 and cut.intercepts == whole.intercepts
    assert {(r.id, r.predicted) for r in bayes.predict_label(counts, cut).collect()} == want
    weights = {(r.term, r.label): r.weight for r in whole.class_weights().collect()}
    assert all(weights[(r.term, r.label)] == pytest.approx(r.weight) for r in cut.class_weights().collect())


def test_model_save_and_load(posts, tmp_path, spark):
    from textmill.sources.models import export_path, save_model

    counts = counts_of(posts)
    model = bayes.fit_nb(counts, posts)
    path = save_model(model, f"{tmp_path}/models", "nb", datetime(2020, 1, 2, 3, 4, 5))
    assert "export_20200102_030405" in path
    again = bayes.LinearModel.load(spark, path)
    want = {(r.id, r.predicted) for r in bayes.predict_nb(counts, model).collect()}
    assert {(r.id, r.predicted) for r in bayes.predict_nb(counts, again).collect()} == want
    with pytest.raises(ValueError):
        export_path("bucket", "x")


def test_one_vs_rest_labels_of_nobody_and_everybody(posts):
    counts = counts_of(posts, ("tags",))
    model = bayes.fit_ovr_nb(counts, posts, ["de", "never"])
    rows = bayes.predict_ovr(counts, model, "id", ["tags"]).collect()
    assert all("never" not in r.predicted for r in rows)
    assert sum(("de" in r.predicted) == ("de" in r.tags) for r in rows) > 70


def brute_knn(docs, k, s, labels):
    """(train, test) dicts id -> (vector dict, tags) to predictions, in plain Python."""
    train_docs, test_docs = docs

    def near(vector, own):
        sims = [
            (-round(sum(v * other.get(t, 0.0) for t, v in vector.items()), 9), i) for i, (other, _) in train_docs.items() if i != own
        ]
        return [i for _, i in sorted(sims)[:k]]

    def votes(vector, own, label):
        return sum(label in train_docs[i][1] for i in near(vector, own))

    out = {}
    for label in labels:
        has = {i: label in tags for i, (_, tags) in train_docs.items()}
        n, total = sum(has.values()), len(has)
        seen = {i: votes(v, i, label) for i, (v, _) in train_docs.items()}
        c1 = [sum(has[i] and seen[i] == j for i in has) for j in range(k + 1)]
        c0 = [sum(not has[i] and seen[i] == j for i in has) for j in range(k + 1)]
        prior = (s + n) / (2 * s + total)
        for i, (vector, _) in test_docs.items():
            j = votes(vector, i, label)
            p1 = prior * (s + c1[j]) / (s * (k + 1) + n)
            p0 = (1 - prior) * (s + c0[j]) / (s * (k + 1) + total - n)
            out[(i, label)] = (int(p1 >= p0), pytest.approx(p1 / (p1 + p0)))
    return out


@pytest.mark.parametrize("k, block_rows", [(1, 1000), (2, 7)])
def test_ml_knn_equals_brute_force(posts, k, block_rows):
    # many copies: short texts over few words repeat often
    counts = counts_of(posts, ("tags",))
    vocab = stage(features.fit_vocab(counts))
    values = features.normalise(features.tfidf(counts, vocab, keep_empty=True))
    packed = stage(knn.pack_vectors(values, "id", ["tags"]))
    train_side, test_side = packed.filter("id % 4 > 0"), packed.filter("id % 4 = 0")

    def as_dict(df):
        return {r.id: (dict(zip(r.terms, r.weights)), r.tags) for r in df.collect()}

    labels = ["de", "en", "odd"]
    want = brute_knn((as_dict(train_side), as_dict(test_side)), k, 0.5, labels)
    got = knn.ml_knn(train_side, test_side, labels, k=k, s=0.5, block_rows=block_rows).collect()
    assert {(r.id, r.label): (r.predicted, r.p) for r in got} == want


def test_metrics_invariants(spark):
    rows = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    pred = spark.createDataFrame(rows, "truth string, predicted string")
    cm = metrics.confusion(pred)
    assert cm.agg(F.sum("n")).first()[0] == 11
    assert metrics.score(pred, "accuracy") == pytest.approx(8 / 11)
    assert metrics.score(pred, "balanced_accuracy") == pytest.approx((5 / 7 + 1 + 0) / 3)
    report = {r.label: r for r in metrics.classification_report(pred).collect()}
    assert report["c"].precision == 0.0 and report["c"].support == 1
    assert report["accuracy"].f1 == pytest.approx(8 / 11)
    wrong = metrics.wrongly_classified(pred)
    assert wrong.count() + metrics.wrongly_classified(pred, correct=True).count() == 11


def test_auc_with_ties_and_one_class(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.1), (0, 0.1)]
    pred = spark.createDataFrame(rows, "truth int, score double")
    pos = [s for t, s in rows if t]
    neg = [s for t, s in rows if not t]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.score(pred, "roc_auc") == pytest.approx(want)
    only = spark.createDataFrame([(1, 0.3), (1, 0.4)], "truth int, score double")
    assert metrics.score(only, "roc_auc") is None
    assert metrics.score(only, "average_precision") == pytest.approx(1.0)


def test_binary_metrics_undefined_values(spark):
    pred = spark.createDataFrame([(0, 0), (0, 0)], "truth int, predicted int")
    row = metrics.binary_metrics(pred).first()
    assert row.precision is None and row.accuracy == 1.0


def test_confidence(spark):
    rows = [("a", "a", 0.9), ("a", "b", 0.8), ("b", "b", 0.4), ("b", "b", 0.95)]
    pred = spark.createDataFrame(rows, "truth string, predicted string, top_p double")
    row = metrics.check_confidence(pred, 0.5).first()
    assert (row.accuracy, row.coverage, row.baseline) == (0.6667, 0.75, 0.75)


def probabilities(spark):
    rows = []
    for i in range(8):
        for model, shift in (("m1", 0.0), ("m2", 0.3)):
            first = min(0.9, 0.1 * i + shift)
            rows += [(i, "x" if i > 3 else "y", model, "x", first), (i, "x" if i > 3 else "y", model, "y", 1 - first)]
    return spark.createDataFrame(rows, "id int, truth string, model string, label string, p double")


def test_vote(spark):
    probs = probabilities(spark)
    alone = vote.vote(probs.filter("model = 'm1'"), {"m1": 3.0}).collect()
    direct = vote.best_label(probs.filter("model = 'm1'")).collect()
    assert {(r.id, r.predicted) for r in alone} == {(r.id, r.predicted) for r in direct}
    tie = spark.createDataFrame([(1, "m", "b", 0.5), (1, "m", "a", 0.5)], "id int, model string, label string, p double")
    assert vote.vote(tie, {"m": 1.0}).first().predicted == "a"
    scores = vote.score_vote_weights(probs, ["m1", "m2"], vote.weight_grid(2, 4))
    best = vote.fit_vote_weights(scores, ["m1", "m2"])
    assert sum(best.values()) == pytest.approx(1.0)
    top = scores.agg(F.max("accuracy")).first()[0]
    voted = vote.vote(probs, best, keep=["truth"]).filter("truth = predicted").count() / 8
    assert voted == pytest.approx(top)
    with pytest.raises(ValueError):
        vote.unit_weights([0, 0])


def test_cooccurrence_and_communities(spark):
    rows = [(["a", "b"],)] * 5 + [(["b", "c", "a"],)] * 2 + [(["x", "y"],)] * 4 + [(["c", "x"],), (["a", "a"],), ([],)]
    df = spark.createDataFrame(rows, "tags array<string>")
    edges = {(r.src, r.dst): r.weight for r in aggregates.cooccurrence(df).collect()}
    assert edges == {("a", "b"): 7, ("a", "c"): 2, ("b", "c"): 2, ("x", "y"): 4, ("c", "x"): 1}
    found = {r.label: r.community for r in graph.communities(aggregates.cooccurrence(df)).collect()}
    assert found["a"] == found["b"] == found["c"] != found["x"] == found["y"]


def plain_modularity(edges, found):
    total, inside, degree = 2 * sum(edges.values()), 0, Counter()
    for (a, b), w in edges.items():
        inside += 2 * w * (found[a] == found[b])
        degree[found[a]] += w
        degree[found[b]] += w
    return inside / total - sum((d / total) ** 2 for d in degree.values())


def test_communities_of_planted_groups(spark):
    rng = random.Random(8)
    edges = {}
    for a in range(30):
        for b in range(a + 1, 30):
            if rng.random() < (0.8 if a // 6 == b // 6 else 0.06):
                edges[(f"n{a:02d}", f"n{b:02d}")] = rng.randint(1, 3)
    df = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, weight long")
    found = {r.label: r.community for r in graph.communities(df).collect()}
    quality = plain_modularity(edges, found)
    assert quality == pytest.approx(graph.modularity(df, spark.createDataFrame(list(found.items()), "label string, community string")))
    assert quality >= plain_modularity(edges, {n: int(n[1:]) // 6 for n in found}) - 1e-9
    assert quality >= plain_modularity(edges, {r.label: r.community for r in graph.label_propagation(df).collect()})
    # no single node gains by moving to another community
    for n in found:
        for c in set(found.values()):
            assert plain_modularity(edges, found | {n: c}) <= quality + 1e-9
    assert graph.communities(df.filter("false")).collect() == []


def test_project_2d_equals_dense_components(spark):
    rng = np.random.default_rng(3)
    dense = np.where(rng.random((60, 25)) < 0.3, rng.random((60, 25)), 0.0)
    dense[:30, :4] += 2.0
    dense[7] = 0.0
    rows = [(i, f"t{j:02d}", float(dense[i, j])) for i in range(60) for j in range(25) if dense[i, j]] + [(7, None, None)]
    found = learners.project_2d(spark.createDataFrame(rows, "id long, term string, value double"), tol=1e-7, max_rounds=200)
    centred = dense - dense.mean(axis=0)
    _, sizes, axes = np.linalg.svd(centred, full_matrices=False)
    assert found.variances == pytest.approx((sizes[:2] ** 2 / 59).tolist())
    points = {r.id: (r.x, r.y) for r in found.points.collect()}
    for j, axis in enumerate(axes[:2]):
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert [points[i][j] for i in range(60)] == pytest.approx((centred @ axis).tolist(), abs=1e-5)
    one = learners.project_2d(spark.createDataFrame([(1, "a", 1.0), (2, None, None)], "id long, term string, value double"))
    assert sorted((r.id, round(abs(r.x), 6), r.y) for r in one.points.collect()) == [(1, 0.5, 0.0), (2, 0.5, 0.0)]
    assert learners.project_2d(spark.createDataFrame([], "id long, term string, value double")).points.collect() == []


def test_document_frequency_bound():
    assert learners.document_frequency_bound(1.0, 50) == 50.0
    assert learners.document_frequency_bound(1, 50) == 1.0


def test_search_helpers(spark):
    assert len(search.expand_grid({"a": [1, 2], "b": ["x", "y", "z"]})) == 6
    assert len(search.draw_grid({"a": [1, 2, 3]}, 2)) == 2
    drawn = search.draw_space({"depth": (1.0, 9.0), "norm": ["l1", "l2"]}, 5, is_int=["depth"])
    assert all(isinstance(p["depth"], int) and 1 <= p["depth"] <= 9 for p in drawn)
    df = spark.range(20).withColumn("fold", (F.col("id") % 2).cast("int"))

    def study(train_part, test_part, params):
        if params["a"] == 2:
            raise InvalidPoint("bad point")
        if params["a"] == 9:
            raise ZeroDivisionError("a real error")
        return params["a"] / 10, float(test_part.count())

    summary, best = search.grid_search(df, {"a": [1, 2, 3]}, study, folds=2)
    rows = {r.a: r for r in summary.collect()}
    assert best == {"a": 3} and rows[2].test_score == 0.0 and rows[3].train_score == 10.0
    with pytest.raises(RuntimeError):
        search.run_studies(df, [{"a": 2}, {"a": 2}], study, 2, max_failed=1)
    with pytest.raises(RuntimeError):  # no point succeeds
        search.run_studies(df, [{"a": 2}], study, 2)
    with pytest.raises(ZeroDivisionError):  # an error of the job is no result
        search.run_studies(df, [{"a": 1}, {"a": 9}], study, 2)
    with pytest.raises(ValueError):  # the second fold would never be tested
        search.run_studies(df, [{"a": 1}], study, 1)


def test_score_log_is_united_by_name(spark, tmp_path):
    from textmill.sources import sinks

    runs = [([(1, 0.5)], "depth int, test_score double"), ([(0.1, 0.9)], "alpha double, test_score double"), ([("l1", 3, 0.7)], "norm string, depth int, test_score double")]
    for rows, schema in runs:
        sinks.append_scores(spark.createDataFrame(rows, schema), f"{tmp_path}/log")
    back = {r.test_score: (r.depth, r.alpha, r.norm) for r in sinks.read_scores(spark, f"{tmp_path}/log").collect()}
    assert back == {0.5: (1, None, None), 0.9: (None, 0.1, None), 0.7: (3, None, "l1")}


def test_long_chain_of_labels_settles(spark):
    edges = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}", 1) for i in range(60)], "src string, dst string, weight long")
    settled = graph.communities(edges).collect()
    assert len(settled) == 61
    with pytest.raises(RuntimeError):
        graph.communities(edges, max_rounds=3)


def test_warm_start(spark):
    rows = [(1, 0.1, 3.0, 0.5), (2, 0.1, 3.0, 0.9), (3, 0.2, 5.0, 0.8), (4, 0.3, 3.0, 0.7), (5, 0.9, 3.0, 0.6), (6, 0.2, 3.0, 0.4)]
    log = spark.createDataFrame(rows, "run_id int, alpha double, cv_folds double, test_score double")
    got = {(r.alpha, r.target) for r in search.warm_start(log, {"alpha": (0.1, 0.5)}, 3).collect()}
    assert got == {(0.1, 0.5), (0.3, 0.7), (0.2, 0.4)}


def test_training_job(posts):
    model, scores = train.train_and_evaluate_nb(posts, train.TrainParams(norm="None", min_df=1.0, tokenizer="space"))
    rows = {r.split: r for r in scores.collect()}
    assert rows["train"].n + rows["eval"].n == 91 and rows["train"].accuracy > 0.7
    tables = train.model_report(posts, train.TrainParams(tokenizer="space"), details=True)
    assert {"accuracy", "report", "confusion", "idf", "weights", "mean_tfidf", "term_totals"} <= set(tables)
    assert all(df.count() > 0 for df in tables.values())


def test_embed_documents_counts_known_tokens_only(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "zz"), (2, "zz"), (3, None)], "id int, term string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "term string, vector array<double>")
    got = {r.id: (r.n_known, r.embedding) for r in features.embed_documents(tokens, vectors).collect()}
    assert got[1] == (3, pytest.approx([2 / 3, 1.0]))
    assert got[2] == (0, [0.0, 0.0]) and got[3] == (0, [0.0, 0.0])


def test_pipeline_wrappers(posts, spark):
    from pyspark.ml import Pipeline

    from textmill.operators.estimators import MeanEmbedding, SoftVote, TextCleaner, TextNaiveBayes

    steps = Pipeline(stages=[TextCleaner(inputCol="text", outputCol="clean"), TextNaiveBayes(inputCol="clean")])
    out = steps.fit(posts).transform(posts)
    assert out.count() == 91 and "predicted" in out.columns
    vectors = spark.createDataFrame([("day", [1.0]), ("tag", [2.0])], "term string, vector array<double>")
    assert MeanEmbedding(vectors=vectors).transform(posts).count() == 91
    fitted = SoftVote(steps=4).fit(probabilities(spark))
    assert fitted.transform(probabilities(spark)).count() == 8


def test_documents_without_label_teach_nothing(spark):
    rows = [("1", "a", "red red blue"), ("2", "b", "blue green"), ("3", "a", "red green"), ("4", None, "blue blue")]
    data = spark.createDataFrame(rows, "id string, label string, text string")
    counts = counts_of(data)
    labelled = bayes.fit_nb(counts.filter("label is not null"), data.filter("label is not null"))
    model = bayes.fit_nb(counts, data)
    assert model.classes == labelled.classes == ["a", "b"]
    assert sorted(model.weights.collect()) == sorted(labelled.weights.collect())


def test_column_stats_of_texts_nan_and_signed_zeros(spark):
    texts = catalog.column_stats(spark.createDataFrame([("x",), ("x",), (None,)], "t string")).first()
    assert (texts["count"], texts.missing, texts.distinct, texts.top, texts.median) == (2, 1, 1, "x", None)
    numbers = catalog.column_stats(spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (4.0,)], "v double")).first()
    assert (numbers["count"], numbers.distinct, numbers.top, numbers.median) == (4, 3, "0.0", 0.0)
    empty = catalog.column_stats(spark.createDataFrame([], "v double")).first()
    assert (empty["count"], empty.median) == (0, None)


def test_running_totals_of_nothing_and_nan(spark):
    assert running_totals(spark.createDataFrame([], "s double, v long"), "s", ["v"]).collect() == []
    rows = running_totals(spark.createDataFrame([(1.0, 1), (2.0, 2), (float("nan"), 4)], "s double, v long"), "s", ["v"], descending=False).collect()
    assert sorted(r.cum_v for r in rows) == [1, 3, 7]
