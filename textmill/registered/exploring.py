"""Joins, counts, distributions, top lists and features over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.text import word_length
from textmill.operators import aggregates, features, metrics
from textmill.operators.search import join_runs
from textmill.operators.splits import with_split
from textmill.registered import register
from textmill.registered.reading import score_log
from textmill.registered.tables import (
    COLOURS, PARTS, POSTS, folded_words, posts, rounded, sql_bucket, sql_lemma, sql_words, table, tagged_parts,
)
from textmill.staging import scalar_of, stage

# ---- joins ----------------------------------------------------------------------------------------------------------


@register(
    "join_results_params",
    """
SELECT o_orderkey AS run_id, o_totalprice AS mean_test_score, l_linenumber AS depth, l_quantity AS alpha
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""",
)
def _(spark, sf):
    results = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_totalprice").alias("mean_test_score"))
    params = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("depth"), F.col("l_quantity").alias("alpha")
    )
    return join_runs(results, params)


@register(
    "attach_predictions",
    """
WITH p AS (SELECT doc_id AS id, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS predicted FROM documents),
t AS (SELECT doc_id AS id, quality AS truth FROM labels), f AS (SELECT doc_id AS id, lang, n_chars FROM documents)
SELECT id, predicted, truth, lang, n_chars FROM p FULL JOIN t USING (id) FULL JOIN f USING (id)
""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    pred = docs.select("id", F.when(F.col("n_chars") > 1500, 1).otherwise(0).alias("predicted"))
    truth = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("truth"))
    return metrics.attach_predictions(pred, truth, docs.select("id", "lang", "n_chars"))


_TOK = f"tok AS (SELECT doc_id AS id, unnest({sql_words('text')}) AS term FROM documents)"
_BENCH = f"vocab AS (SELECT DISTINCT unnest({sql_words('text')}) AS term FROM benchmark)"


def doc_tokens(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return features.explode_tokens(docs, "text", "id", ["lang"], folded_words)


def doc_counts(spark, sf):
    return features.term_counts(doc_tokens(spark, sf), "id", ["lang"])


@register(
    "in_vocab_join",
    f"WITH {_TOK}, {_BENCH} SELECT id, count(*) AS n FROM tok SEMI JOIN vocab USING (term) GROUP BY id",
)
def _(spark, sf):
    vocab = table(spark, sf, "benchmark").select(F.explode(folded_words(F.col("text"))).alias("term")).distinct()
    return features.in_vocab(doc_tokens(spark, sf), vocab).groupBy("id").agg(F.count("*").alias("n"))


@register(
    "lemma_lookup",
    f"""
WITH {_TOK}, {_BENCH}, forms AS (SELECT term, upper(term) AS lemma FROM vocab)
SELECT coalesce(lemma, tok.term) AS term, count(*) AS n FROM tok LEFT JOIN forms ON tok.term = forms.term GROUP BY 1
""",
)
def _(spark, sf):
    vocab = table(spark, sf, "benchmark").select(F.explode(folded_words(F.col("text"))).alias("term")).distinct()
    lexicon = vocab.select("term", F.upper("term").alias("lemma"))
    tokens = doc_tokens(spark, sf).filter(F.col("term").isNotNull())
    return features.lemma_lookup(tokens, lexicon).groupBy("term").agg(F.count("*").alias("n"))


# ---- aggregates -----------------------------------------------------------------------------------------------------

_YEARLY = """
SELECT * FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
    round(100 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 1) AS percent
  FROM orders GROUP BY 1) WHERE year > 1995 AND year < 2001 ORDER BY year
"""


def yearly(spark, sf):
    return aggregates.yearly_rate(table(spark, sf, "orders"), "o_orderdate", F.col("o_orderstatus") == "F", 1995, 2001)


@register("yearly_answer_rate", _YEARLY)
def _(spark, sf):
    return yearly(spark, sf)


@register("ordered_years", f"SELECT year, n FROM ({_YEARLY})")
def _(spark, sf):
    return yearly(spark, sf).select("year", "n")


_TAG_COUNTS = "counts AS (SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM parts) GROUP BY tag)"


@register("tag_counts", f"WITH {PARTS}, {_TAG_COUNTS} SELECT tag, n FROM counts")
def _(spark, sf):
    return aggregates.tag_counts(tagged_parts(spark, sf))


@register("top_tags", f"WITH {PARTS}, {_TAG_COUNTS} SELECT tag, n FROM counts WHERE tag <> '' ORDER BY n DESC, tag LIMIT 10")
def _(spark, sf):
    return aggregates.top_tags(aggregates.tag_counts(tagged_parts(spark, sf)), 10)


@register("keep_tags", f"WITH {PARTS}, {_TAG_COUNTS} SELECT tag, n FROM counts ORDER BY n DESC, tag LIMIT 100")
def _(spark, sf):
    return aggregates.keep_tags(tagged_parts(spark, sf), 100)


@register(
    "split_summary",
    f"""
SELECT CASE WHEN {sql_bucket('doc_id')} < 20 THEN 'eval' ELSE 'train' END AS split, count(*) AS n,
  count(DISTINCT source) AS n_labels FROM documents GROUP BY 1
""",
)
def _(spark, sf):
    docs = with_split(table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 20)
    return aggregates.split_summary(docs, "split", "source").withColumn("n", F.col("n").cast("bigint"))


_TF = f"""
{_TOK}, tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term),
n AS (SELECT count(*) AS n FROM documents),
vocab AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf,
    ln((1 + (SELECT n FROM n)) / (1 + count(*))::DOUBLE) + 1 AS idf
  FROM tf GROUP BY term),
raw AS (SELECT id, term, tf, tf * idf AS v FROM tf JOIN vocab USING (term)),
val AS (SELECT id, term, tf, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS value FROM raw)
"""


@register("term_totals", f"WITH {_TF} SELECT term, cf FROM vocab")
def _(spark, sf):
    return features.term_totals(doc_counts(spark, sf))


@register(
    "mean_tfidf",
    f"WITH {_TF} SELECT term, round(sum(value) / (SELECT n FROM n), 6) AS mean_tfidf FROM val GROUP BY term",
)
def _(spark, sf):
    counts = stage(doc_counts(spark, sf), "counts")
    n_docs = scalar_of(table(spark, sf, "documents"), F.count("*"))
    values = features.normalise(features.tfidf(counts, features.fit_vocab(counts, n_docs=n_docs)), "l2")
    return rounded(features.mean_tfidf(values, n_docs))


def vocab_of(spark, sf, **params):
    n_docs = scalar_of(table(spark, sf, "documents"), F.count("*"))
    return features.fit_vocab(doc_counts(spark, sf), n_docs=n_docs, **params)


@register("doc_freq_idf", f"WITH {_TF} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab")
def _(spark, sf):
    return rounded(vocab_of(spark, sf))


@register(
    "count_vectorise",
    f"""WITH {_TF}, kept AS (SELECT term FROM vocab WHERE df >= 5 AND df <= 0.5 * (SELECT n FROM n) ORDER BY cf DESC, term LIMIT 1000)
SELECT id, term, tf FROM tf SEMI JOIN kept USING (term)""",
)
def _(spark, sf):
    counts = stage(doc_counts(spark, sf), "counts")
    n_docs = scalar_of(table(spark, sf, "documents"), F.count("*"))
    vocab = features.fit_vocab(counts, 5, 0.5, 1000, n_docs=n_docs)
    return features.in_vocab(counts, vocab).select("id", "term", "tf")


@register(
    "index_vocab",
    f"WITH {_TF} SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab",
)
def _(spark, sf):
    indexed = features.index_vocab(vocab_of(spark, sf))
    return indexed.select("term", "df", "cf", F.col("idx").cast("bigint").alias("idx"))


@register("tfidf", f"WITH {_TF} SELECT id, term, tf, round(v, 6) AS value FROM raw")
def _(spark, sf):
    counts = stage(doc_counts(spark, sf), "counts")
    n_docs = scalar_of(table(spark, sf, "documents"), F.count("*"))
    return rounded(features.tfidf(counts, features.fit_vocab(counts, n_docs=n_docs)).select("id", "term", "tf", "value"))


@register(
    "normalise",
    f"""WITH {_TF} SELECT id, term, round(v / sum(v) OVER (PARTITION BY id), 6) AS l1,
round(v / sqrt(sum(v * v) OVER (PARTITION BY id)), 6) AS l2 FROM raw""",
)
def _(spark, sf):
    counts = stage(doc_counts(spark, sf), "counts")
    n_docs = scalar_of(table(spark, sf, "documents"), F.count("*"))
    raw = features.tfidf(counts, features.fit_vocab(counts, n_docs=n_docs)).select("id", "term", "value")
    l1 = features.normalise(raw.withColumn("keep", F.col("value")), "l1").select("id", "term", F.col("value").alias("l1"), "keep")
    l2 = features.normalise(l1.withColumn("value", F.col("keep")), "l2")
    return rounded(l2.select("id", "term", "l1", F.col("value").alias("l2")))


@register(
    "tfidf_vectorise",
    r"""
WITH w AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '') AS w FROM documents),
tok AS (SELECT id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY id, term), n AS (SELECT count(*) AS n FROM documents),
vocab AS (SELECT term, ln((1 + (SELECT n FROM n)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf GROUP BY term
  HAVING count(*) >= 10 AND count(*) <= 0.75 * (SELECT n FROM n)),
raw AS (SELECT id, term, tf, tf * idf AS v FROM tf JOIN vocab USING (term))
SELECT id, term, tf, round(v / sqrt(sum(v * v) OVER (PARTITION BY id)), 6) AS value FROM raw
""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return rounded(features.tfidf_vectorise(docs, "text", ngram_range=(1, 2), min_df=10, max_df=0.75))


@register(
    "length_histogram",
    """
SELECT 'title' AS field, length, count(*) AS n FROM (SELECT len(string_split(string_split(text, chr(10))[1], ' ')) AS length FROM documents) GROUP BY 2
UNION ALL
SELECT 'body', length, count(*) FROM (SELECT len(string_split(text, ' ')) AS length FROM documents) GROUP BY 2
""",
)
def _(spark, sf):
    lengths = posts(spark, sf).select(
        word_length(F.col("title")).alias("title"), word_length(F.col("body")).alias("body")
    ).unpivot([], ["title", "body"], "field", "length")
    counted = lengths.groupBy("field", "length").agg(F.count("*").alias("n"))
    return counted.withColumn("length", F.col("length").cast("bigint"))


@register(
    "length_histogram_binned",
    """
WITH l AS (SELECT len(string_split(text, ' '))::DOUBLE AS v FROM documents), b AS (SELECT min(v) AS lo, max(v) AS hi FROM l),
x AS (SELECT CAST(least(floor((v - lo) * 25 / (hi - lo)), 24) AS BIGINT) AS bin FROM l, b)
SELECT bin, round(min(lo + bin * ((hi - lo) / 25)), 6) AS low, round(min(lo + (bin + 1) * ((hi - lo) / 25)), 6) AS high, count(*) AS n
FROM x, b GROUP BY bin
""",
)
def _(spark, sf):
    lengths = posts(spark, sf).select(word_length(F.col("body")).alias("length"))
    return rounded(aggregates.equal_width_hist(lengths, "length", 25))


@register(
    "relative_frequency",
    f"WITH {PARTS} SELECT p_type AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM parts), 6) AS share FROM parts GROUP BY 1",
)
def _(spark, sf):
    return rounded(aggregates.relative_frequency(tagged_parts(spark, sf), "p_type"))


_USER_TAGS = """
users AS (SELECT user_id AS id, list_sort(list_distinct(list(event_type))) AS tags FROM events GROUP BY user_id)"""


def user_tags(spark, sf):
    """The set of event types of every user: short arrays, since the event types are few."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.array_sort(F.collect_set("event_type")).alias("tags")
    )


@register(
    "label_cooccurrence",
    f"""WITH {PARTS}, e AS (SELECT id, unnest(list_distinct(tags)) AS tag FROM parts)
SELECT a.tag AS src, b.tag AS dst, count(*) AS weight FROM e a JOIN e b ON a.id = b.id AND a.tag < b.tag GROUP BY 1, 2""",
)
def _(spark, sf):
    return aggregates.cooccurrence(tagged_parts(spark, sf))


@register(
    "user_cooccurrence",
    f"""WITH {_USER_TAGS}, e AS (SELECT id, unnest(tags) AS tag FROM users)
SELECT a.tag AS src, b.tag AS dst, count(*) AS weight FROM e a JOIN e b ON a.id = b.id AND a.tag < b.tag GROUP BY 1, 2""",
)
def _(spark, sf):
    return aggregates.cooccurrence(user_tags(spark, sf))


@register(
    "label_powerset_counts",
    f"WITH {PARTS} SELECT array_to_string(list_sort(list_distinct(tags)), ' ') AS tagset, count(*) AS n FROM parts GROUP BY 1",
)
def _(spark, sf):
    return aggregates.tagset_counts(tagged_parts(spark, sf))


@register(
    "class_weights",
    "SELECT lang AS label, count(*) AS n, round((SELECT count(*) FROM documents) / (4 * count(*))::DOUBLE, 6) AS weight FROM documents GROUP BY 1",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("label"))
    return rounded(aggregates.balanced_weights(docs))


@register(
    "class_weights_dict",
    "SELECT doc_id, CASE lang WHEN 'en' THEN 0.5 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))
    return aggregates.with_weights(docs, {"en": 0.5, "fr": 2.0}).drop("label")


@register(
    "index_label",
    """
WITH i AS (SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_index FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, source, label_index FROM documents JOIN i ON source = label
""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return docs.join(aggregates.index_labels(docs, "source"), F.col("source") == F.col("label")).drop("label")


# ---- top lists ------------------------------------------------------------------------------------------------------


def _extremes_sql(source: str, measure: str, n: int = 20) -> str:
    return f"""
SELECT term, round({measure}, 6) AS {measure}, 'smallest' AS side FROM (SELECT * FROM {source} ORDER BY {measure}, term LIMIT {n})
UNION ALL
SELECT term, round({measure}, 6) AS {measure}, 'largest' AS side FROM (SELECT * FROM {source} ORDER BY {measure} DESC, term LIMIT {n})"""


@register("idf_extremes", f"WITH {_TF} {_extremes_sql('vocab', 'idf')}")
def _(spark, sf):
    return rounded(features.extremes(vocab_of(spark, sf), "idf"))


@register(
    "frequent_terms",
    f"""WITH {_TF} SELECT term, cf, 'most' AS side FROM (SELECT * FROM vocab ORDER BY cf DESC, term LIMIT 30)
UNION ALL SELECT term, cf, 'least' FROM (SELECT * FROM vocab ORDER BY cf, term LIMIT 10)""",
)
def _(spark, sf):
    return features.frequent_terms(stage(features.term_totals(doc_counts(spark, sf)), "totals"))


@register(
    "longest_shortest_term",
    f"""WITH {_TF} SELECT (SELECT term FROM vocab ORDER BY length(term) DESC, term LIMIT 1) AS longest,
(SELECT term FROM vocab ORDER BY length(term), term LIMIT 1) AS shortest""",
)
def _(spark, sf):
    return features.term_length_extremes(doc_tokens(spark, sf).select("term").filter("term IS NOT NULL").distinct())


# ---- embeddings -----------------------------------------------------------------------------------------------------

_VECTORS = f"""
{_BENCH}, vectors AS (
  SELECT term, list_transform(generate_series(1, 8), lambda i: {sql_bucket("term || '/' || i", 1000)} / 997.0::DOUBLE) AS vector FROM vocab)"""


def word_table(spark, sf):
    """A made vector per benchmark word: eight hash values between 0 and 1."""
    from textmill.functions.numeric import fingerprint_bucket

    vocab = table(spark, sf, "benchmark").select(F.explode(folded_words(F.col("text"))).alias("term")).distinct()
    parts = [fingerprint_bucket(F.concat("term", F.lit(f"/{i}")), 1000) / 997.0 for i in range(1, 9)]
    return vocab.select("term", F.array(*parts).alias("vector"))


@register(
    "embed_mean",
    f"""
WITH {_TOK}, {_VECTORS}, j AS (SELECT id, vector FROM tok JOIN vectors USING (term)),
m AS (SELECT id, count(*) AS n_known, """
    + ", ".join(f"avg(vector[{i}]) AS e{i}" for i in range(1, 9))
    + " FROM j GROUP BY id) SELECT doc_id AS id, coalesce(n_known, 0) AS n_known, "
    + ", ".join(f"round(coalesce(e{i}, 0), 6) AS e{i}" for i in range(1, 9))
    + " FROM documents LEFT JOIN m ON doc_id = id",
)
def _(spark, sf):
    means = features.embed_documents(doc_tokens(spark, sf).select("id", "term"), stage(word_table(spark, sf), "words"))
    return rounded(means.select("id", F.col("n_known").cast("bigint"), *[F.col("embedding")[i].alias(f"e{i + 1}") for i in range(8)]))


@register(
    "embedding_class_means",
    "SELECT label, " + ", ".join(f"round(avg(embedding[{i}]::DOUBLE), 6) AS e{i}" for i in range(1, 65)) + ", count(*) AS n FROM embeddings GROUP BY label",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    means = [F.avg(F.col("embedding")[i].cast("double")).alias(f"e{i + 1}") for i in range(64)]
    return rounded(vectors.groupBy("label").agg(*means, F.count("*").alias("n")))


