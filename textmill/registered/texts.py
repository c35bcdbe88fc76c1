"""Text, tag and numeric functions over the test tables."""

from __future__ import annotations

import functools
import hashlib
import re

from pyspark.sql import functions as F

from textmill.functions import lexicon, numeric
from textmill.functions import tags as T
from textmill.functions import text as X
from textmill.operators.records import map_records
from textmill.plans.clean import clean_posts
from textmill.registered import register
from textmill.registered.tables import (
    COLOURS, ENTITY_TOKEN_SQL, PARTS, POSTS, folded_words, posts, rounded, sql_block, sql_bucket, sql_clean, sql_entities,
    sql_fold, sql_keep, sql_lemma, sql_lemmatise, sql_list, sql_strip_punct, sql_visible, sql_words, table, tagged_parts,
)
from textmill.staging import spread


def documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def squeezed(col):
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def sql_squeezed(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


# pages hold no <code>, so two other block tags stand in for the second one
@register(
    "extract_blocks",
    f"SELECT page_id, {sql_squeezed(sql_block('html', 'p'))} AS p_text, {sql_squeezed(sql_block('html', 'li'))} AS li_text, "
    f"{sql_squeezed(sql_block('html', 'code'))} AS code_text FROM pages",
)
def _(spark, sf):
    blocks = X.extract_blocks(spread(table(spark, sf, "pages")), "html", ["p", "li", "code"])
    return blocks.select("page_id", *[squeezed(F.col(c)).alias(c) for c in ("p_text", "li_text", "code_text")])


@register(
    "html_text",
    "SELECT page_id, "
    + sql_squeezed(sql_entities("regexp_replace(" + sql_visible("html") + ", '<[A-Za-z/!][^>]*>', ' ', 'g')"))
    + " AS html_text FROM pages",
)
def _(spark, sf):
    return spread(table(spark, sf, "pages")).select("page_id", X.html_text(F.col("html")).alias("html_text"))


@register("fold_accents", f"SELECT doc_id, {sql_fold('text')} AS folded FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", X.fold_accents(F.col("text")).alias("folded"))


def _token_query(name: str, tokens, sql: str) -> None:
    @register(name, f"SELECT doc_id, len(t) AS n, md5(array_to_string(t, chr(1))) AS digest FROM (SELECT doc_id, {sql} AS t FROM documents)")
    def _(spark, sf):
        found = documents(spark, sf).select("doc_id", tokens(F.col("text")).alias("t"))
        return found.select(
            "doc_id", F.array_size("t").cast("bigint").alias("n"), F.md5(F.array_join("t", "\x01")).alias("digest")
        )


def folded(how: str):
    return lambda c: X.tokenise(X.fold_accents(c), how)


_token_query(
    "tokenise_space",
    lambda c: X.tokenise(c, "space"),
    r"list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')",
)
_token_query("tokenise_words", folded_words, sql_words("text"))
_token_query("tokenise_punct", folded("punct"), rf"regexp_extract_all({sql_fold('text')}, '\w+|[^\w\s]')")
_TOKENS = f"regexp_extract_all({sql_fold('text')}, '{ENTITY_TOKEN_SQL}')"
_token_query(
    "token_filters", lambda c: X.token_filters(folded("entities")(c)), f"list_filter({_TOKENS}, lambda t: {sql_keep('t')})"
)
_token_query(
    "symbol_stopwords",
    lambda c: X.token_filters(folded("punct")(c), "symbols"),
    rf"list_filter(regexp_extract_all({sql_fold('text')}, '\w+|[^\w\s]'), lambda t: lower(t) NOT IN ({sql_list(lexicon.STOP_WORDS)})"
    r" AND NOT regexp_matches(t, '^[[:punct:]0-9]$'))",
)
_WORDS_SQL = sql_words("text")
_token_query(
    "ngrams",
    lambda c: X.ngrams(folded_words(c), 1, 3),
    f"list_concat(list_concat({_WORDS_SQL}, "
    f"list_transform(generate_series(1, len({_WORDS_SQL}) - 1), lambda i: array_to_string(list_slice({_WORDS_SQL}, i, i + 1), ' '))), "
    f"list_transform(generate_series(1, len({_WORDS_SQL}) - 2), lambda i: array_to_string(list_slice({_WORDS_SQL}, i, i + 2), ' ')))"
    .replace(f"list_slice({_WORDS_SQL}", "list_slice(w")
    .replace(f"len({_WORDS_SQL})", "len(w)")
    .replace(f"list_concat(list_concat({_WORDS_SQL}", "list_concat(list_concat(w")
    .join(["(SELECT ", f" FROM (SELECT {_WORDS_SQL} AS w))"]),
)


@register("lemmatise", f"SELECT doc_id, {sql_lemmatise(sql_fold('text'))} AS lemmas FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", X.lemmatise(X.fold_accents(F.col("text"))).alias("lemmas"))


@register("strip_punct", f"SELECT doc_id, {sql_strip_punct('text')} AS stripped FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", X.strip_punct(F.col("text")).alias("stripped"))


@register("clean_text", f"SELECT conv_id, turn, {sql_clean('text')} AS clean FROM conversations")
def _(spark, sf):
    talk = spread(table(spark, sf, "conversations"))
    return talk.select("conv_id", "turn", X.clean_text(F.col("text")).alias("clean"))


@register(
    "clean_posts",
    f"""
SELECT page_id AS id, {sql_clean('url')} AS title, {sql_clean(sql_block('html', 'p'))} AS text_body,
  {sql_clean(sql_block('html', 'code'))} AS code_body, '' AS tags FROM pages
""",
)
def _(spark, sf):
    raw = spread(table(spark, sf, "pages")).select(
        F.col("page_id").alias("id"), F.col("url").alias("title"), F.col("html").alias("body"),
        F.split("url", "/").alias("tags"),
    )
    return clean_posts(raw).withColumn("tags", F.array_join("tags", "-"))


@register(
    "model_text",
    "SELECT conv_id, turn, role || text AS text, role || ' ' || text AS spaced FROM conversations",
)
def _(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", X.model_text("role", "text").alias("text"), X.model_text("role", "text", sep=" ").alias("spaced")
    )


@register("word_length", f"WITH {POSTS} SELECT id, len(string_split(title, ' ')) AS title_length, len(string_split(body, ' ')) AS body_length, len(tags) AS tags_length FROM posts")
def _(spark, sf):
    lengths = posts(spark, sf).select(
        "id", X.word_length(F.col("title")).alias("title_length"), X.word_length(F.col("body")).alias("body_length"),
        F.array_size("tags").alias("tags_length"),
    )
    return lengths.select("id", *[F.col(c).cast("bigint").alias(c) for c in lengths.columns[1:]])


@register("array_length", f"WITH {PARTS} SELECT id, len(tags) AS tags_length FROM parts")
def _(spark, sf):
    return tagged_parts(spark, sf).select("id", F.array_size("tags").cast("bigint").alias("tags_length"))


@register(
    "raw_lengths",
    f"SELECT page_id, len(string_split({sql_block('html', 'p')}, ' ')) AS body_words, "
    f"len(string_split({sql_block('html', 'code')}, ' ')) AS code_words FROM pages",
)
def _(spark, sf):
    lengths = X.raw_lengths(spread(table(spark, sf, "pages")), "html", "page_id")
    return lengths.select("page_id", F.col("body_words").cast("bigint"), F.col("code_words").cast("bigint"))


# ---- tags -----------------------------------------------------------------------------------------------------------


@register(
    "tag_intersect",
    f"WITH {PARTS} SELECT id, array_to_string(list_intersect(list_concat(tags, tags), [{sql_list(COLOURS)}]), '-') AS tags FROM parts",
)
def _(spark, sf):
    twice = tagged_parts(spark, sf).select("id", F.concat("tags", "tags").alias("tags"))
    return twice.select("id", F.array_join(T.intersect_tags(F.col("tags"), COLOURS), "-").alias("tags"))


@register(
    "split_tags",
    "SELECT p_partkey, array_to_string(string_split(p_brand || '|' || p_type, '|'), ' ') AS tags, 2::BIGINT AS n FROM part",
)
def _(spark, sf):
    joined = table(spark, sf, "part").select("p_partkey", F.concat_ws("|", "p_brand", "p_type").alias("t"))
    split = joined.select("p_partkey", T.split_tags(F.col("t")).alias("tags"))
    return split.select("p_partkey", F.array_join("tags", " ").alias("tags"), F.array_size("tags").cast("bigint").alias("n"))


@register(
    "build_tag",
    f"WITH {PARTS} SELECT id, array_to_string(list_filter(list_concat(tags, tags), lambda t: t IN ({sql_list(COLOURS)})), '-') AS tags FROM parts",
)
def _(spark, sf):
    twice = tagged_parts(spark, sf).select("id", F.concat("tags", "tags").alias("tags"))
    return twice.select("id", F.array_join(T.build_tag(F.col("tags"), COLOURS), "-").alias("tags"))


@register(
    "first_label",
    f"WITH {PARTS} SELECT id, coalesce(list_filter(tags, lambda t: t IN ({sql_list(COLOURS)}))[1], 'other-tags') AS label FROM parts",
)
def _(spark, sf):
    return tagged_parts(spark, sf).select("id", T.first_label(T.build_tag(F.col("tags"), COLOURS)).alias("label"))


@register("joined_label", f"WITH {PARTS} SELECT id, array_to_string(tags, ',') AS label, array_to_string(tags, ' ') AS spaced FROM parts")
def _(spark, sf):
    tags = F.col("tags")
    return tagged_parts(spark, sf).select("id", T.joined_label(tags).alias("label"), T.joined_label(tags, " ").alias("spaced"))


@register("powerset_label", f"WITH {PARTS} SELECT id, array_to_string(list_sort(list_distinct(tags)), '|') AS label FROM parts")
def _(spark, sf):
    return tagged_parts(spark, sf).select("id", T.powerset_label(F.col("tags")).alias("label"))


@register(
    "binarise_labels",
    f"WITH {PARTS} SELECT id, " + ", ".join(f"CAST(list_contains(tags, '{c}') AS INTEGER) AS is_{c}" for c in COLOURS) + " FROM parts",
)
def _(spark, sf):
    return T.binarise_labels(tagged_parts(spark, sf).select("id", "tags"), COLOURS).drop("tags")


# ---- numbers --------------------------------------------------------------------------------------------------------


@register("year_of", "SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numeric.year_of(F.col("l_shipdate")).alias("year"))


@register(
    "scalar_math",
    """
SELECT c_custkey, round(c_acctbal, 1) AS rounded, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS flag,
  CAST(c_custkey AS VARCHAR) AS text, round(abs(c_acctbal), 2) AS absolute, c_custkey % 7 AS rest FROM customer
""",
)
def _(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(balance, 1).alias("rounded"), F.when(balance > 0, 1).otherwise(0).alias("flag"),
        F.col("c_custkey").cast("string").alias("text"), F.round(F.abs(balance), 2).alias("absolute"),
        F.pmod("c_custkey", F.lit(7)).alias("rest"),
    )


@register("fingerprint_bucket", f"SELECT o_orderkey, {sql_bucket('o_orderkey')} AS bucket FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", numeric.fingerprint_bucket(F.col("o_orderkey")).alias("bucket"))


@register("rand")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", numeric.uniform(7).alias("u"))


@register(
    "vector_distances",
    """
WITH c AS (SELECT label, list_transform(generate_series(1, 64), lambda i: 1.0) AS u FROM embeddings),
m AS (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, vec_id FROM embeddings)
SELECT vec_id, round(list_distance(e, list_transform(e, lambda x: x * x + 0.5)), 6) AS euclidean,
  round(list_cosine_distance(e, list_transform(e, lambda x: x * x + 0.5)), 6) AS cosine FROM m
""",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    other = F.transform("e", lambda x: x * x + 0.5)
    return rounded(
        vectors.select(
            "vec_id", numeric.distance(F.col("e"), other).alias("euclidean"),
            numeric.distance(F.col("e"), other, "cosine").alias("cosine"),
        )
    )


@register(
    "cost_class",
    """
SELECT event_id, CASE WHEN value * 4 >= 300 THEN 'TIME-ERROR2' WHEN value * 4 >= 60 THEN 'TIME-ERROR1'
  WHEN value * 4 < 60 THEN 'TIME-OK' END AS class FROM events
""",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", numeric.cost_class(F.col("value") * 4).alias("class"))


@register(
    "max_probability",
    "SELECT vec_id, round(CAST(list_max(embedding) AS DOUBLE), 6) AS top FROM embeddings",
)
def _(spark, sf):
    top = numeric.max_probability(F.col("embedding")).cast("double")
    return rounded(table(spark, sf, "embeddings").select("vec_id", top.alias("top")))


@register(
    "lemma_tokens",
    f"""
WITH t AS (SELECT doc_id, unnest({_WORDS_SQL}) AS term FROM documents), l AS (SELECT term, {sql_lemma('term')} AS lemma FROM t)
SELECT lemma, count(*) AS n FROM l GROUP BY lemma
""",
)
def _(spark, sf):
    words = documents(spark, sf).select(F.explode(folded_words(F.col("text"))).alias("term"))
    # each distinct word is lemmatised once
    counted = words.groupBy("term").agg(F.count("*").alias("n"))
    return counted.groupBy(X.lemma(F.col("term")).alias("lemma")).agg(F.sum("n").alias("n"))


class Paragraphs:
    """Record function: one row per closed paragraph of a page; a page that leaves more than ``most`` paragraphs open is an error."""

    def __init__(self, most: int):
        self.most = most

    def setup(self) -> None:
        self.invisible, self.paragraph = re.compile(X.INVISIBLE), re.compile(r"(?s)<p>(.*?)</p>")

    def process(self, row):
        html = self.invisible.sub("", row["html"] or "")
        left = html.count("<p>") - html.count("</p>")
        for text in self.paragraph.findall(html):
            yield {"n_chars": len(text), "digest": hashlib.md5(text.encode()).hexdigest()}
        if left > self.most:
            raise ValueError(f"{left} paragraphs are left open")


@register(
    "map_records",
    f"""
WITH v AS (SELECT page_id, {sql_visible('html')} AS html FROM pages),
c AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS found,
  (length(html) - length(replace(html, '<p>', ''))) // 3 - (length(html) - length(replace(html, '</p>', ''))) // 4 AS open FROM v),
r AS (SELECT page_id, unnest(found) AS text, unnest(range(len(found))) AS place FROM c WHERE open <= 3)
SELECT page_id, 'record' AS kind, place, length(text) AS n, md5(text) AS said, NULL AS cost FROM r UNION ALL
SELECT page_id, 'outcome', NULL, CASE WHEN open <= 3 THEN len(found) ELSE 0 END,
  CASE WHEN open > 3 THEN 'ValueError: ' || open || ' paragraphs are left open' END, 'TIME-OK' FROM c
""",
)
def _(spark, sf):
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    mapped = map_records(pages, functools.partial(Paragraphs, 3), "n_chars bigint, digest string", "page_id")
    records = mapped.records().select("page_id", F.lit("record").alias("kind"), "place", F.col("n_chars").alias("n"), F.col("digest").alias("said"), F.lit(None).cast("string").alias("cost"))
    outcomes = mapped.outcomes().select("page_id", F.lit("outcome").alias("kind"), F.lit(None).cast("bigint").alias("place"), "n", F.col("error").alias("said"), "cost")
    return records.unionByName(outcomes)
