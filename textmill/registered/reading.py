"""Sources, sinks, projections, filters and catalog rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textmill.functions.tags import all_tags_in, nest_tags
from textmill.operators import aggregates, catalog, splits
from textmill.plans.clean import clean_posts
from textmill.plans.train import to_model_frame
from textmill.registered import register
from textmill.registered.tables import (
    COLOURS, PARTS, POSTS, posts, rounded, sql_bucket, sql_clean, sql_hash, sql_list, table, tagged_parts,
)
from textmill.sources import readers, sinks
from textmill.staging import checkpoint_root, spread


def scratch(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/textmill/{name}-{uuid.uuid4().hex}"


@register("read_posts", "SELECT doc_id, text, lang, source FROM documents")
def _(spark, sf):
    return readers.read_posts(spark, f"{sf}/documents.parquet", ["doc_id", "text", "lang", "source"])


@register("read_limit", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def _(spark, sf):
    return readers.read_table(spark, f"{sf}/documents.parquet", ["doc_id", "lang", "n_chars"], 100, "doc_id")


@register(
    "conform_schema",
    "SELECT doc_id AS id, lang AS title, text AS text_body, source AS code_body, lang || '-' || source AS tags FROM documents",
)
def _(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.col("doc_id").cast("decimal(38,9)").alias("id"), F.col("lang").alias("title"), F.col("text").alias("text_body"),
        F.col("source").alias("code_body"), F.array("lang", "source").alias("tags"),
    )
    return readers.conform(raw).withColumn("tags", F.array_join("tags", "-"))


@register(
    "nest_tags",
    f"WITH {PARTS} SELECT id, array_to_string(tags, ' ') AS tag_values FROM parts",
)
def _(spark, sf):
    nested = tagged_parts(spark, sf).select("id", nest_tags(F.col("tags")).alias("tags"))
    return nested.select("id", F.array_join(F.transform("tags", lambda t: t["value"]), " ").alias("tag_values"))


@register("write_table_truncate", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    path = scratch(spark, "customers")
    source = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_table(source, path, "new")
    sinks.write_table(source, path, "truncate")
    return spark.read.parquet(path)


@register("write_table_new", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    path = scratch(spark, "nations")
    sinks.write_table(table(spark, sf, "nation").select("n_nationkey", "n_name"), path, "new")
    return spark.read.parquet(path)


LINE_SQL = f"""
WITH {POSTS}, clean AS (SELECT id, {sql_clean('title')} AS title, {sql_clean('body')} AS text_body, tags FROM posts)
SELECT id || ', ' || title || ', ' || text_body || ', ' || '' || ', ' || array_to_string(tags, '-') AS line FROM clean
"""


LABELS = ["en", "fr", "de", "es", *[f"src{i}" for i in range(20)]]


def _clean(spark, sf):
    return clean_posts(spread(posts(spark, sf)), LABELS, html=False)


@register("to_text_lines", LINE_SQL)
def _(spark, sf):
    return sinks.to_text_lines(_clean(spark, sf))


@register("write_text_lines", LINE_SQL)
def _(spark, sf):
    path = scratch(spark, "lines")
    sinks.write_text(_clean(spark, sf), path)
    return spark.read.text(path).filter(F.col("value") != ", ".join(sinks.TEXT_HEADER)).select(F.col("value").alias("line"))


@register(
    "read_text_lines",
    f"""
WITH {POSTS}, clean AS (SELECT id, {sql_clean('title')} AS title, {sql_clean('body')} AS text_body, tags FROM posts)
SELECT CAST(id AS VARCHAR) AS id, title, text_body, '' AS code_body, array_to_string(tags, '-') AS tags FROM clean
""",
)
def _(spark, sf):
    path = scratch(spark, "lines")
    sinks.write_text(_clean(spark, sf), path)
    return readers.read_text_lines(spark, path, sinks.TEXT_HEADER)


@register(
    "to_json_records",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS record
FROM customer""",
)
def _(spark, sf):
    return sinks.to_json_records(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"))


SCORES_SQL = """
SELECT c_nationkey AS max_depth, c_custkey AS run_id, CAST(c_custkey % 3 + 3 AS DOUBLE) AS cv_folds,
       c_acctbal / 10000 AS test_score FROM customer WHERE c_acctbal IS NOT NULL
"""


def score_log(spark, sf):
    """customer rows as a log of earlier searches."""
    return table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("max_depth"), F.col("c_custkey").alias("run_id"),
        (F.col("c_custkey") % 3 + 3).cast("double").alias("cv_folds"), (F.col("c_acctbal") / 10000).alias("test_score"),
    )


@register(
    "score_log_append",
    f"""
WITH s AS ({SCORES_SQL}), a AS (SELECT max_depth, run_id, cv_folds, test_score, NULL::DOUBLE AS alpha FROM s WHERE run_id % 2 = 0),
b AS (SELECT NULL::INTEGER AS max_depth, run_id, cv_folds, test_score, run_id / 10.0::DOUBLE AS alpha FROM s WHERE run_id % 2 = 1)
SELECT run_id, max_depth, alpha, cv_folds, round(test_score, 6) AS test_score FROM a UNION ALL
SELECT run_id, max_depth, alpha, cv_folds, round(test_score, 6) AS test_score FROM b
""",
)
def _(spark, sf):
    log = score_log(spark, sf)
    old = log.filter(F.col("run_id") % 2 == 0)
    new = log.filter(F.col("run_id") % 2 == 1).drop("max_depth").withColumn("alpha", F.col("run_id") / 10.0)
    path = scratch(spark, "scores")
    sinks.append_scores(old, path)
    sinks.append_scores(new, path)
    return rounded(sinks.read_scores(spark, path), "test_score").select("run_id", "max_depth", "alpha", "cv_folds", "test_score")


@register(
    "batch_read",
    f"""
WITH p AS (SELECT doc_id, lang, CAST({sql_bucket('doc_id', 16, 'b')} AS INTEGER) AS part FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY {sql_hash('doc_id', 'border')}, doc_id) AS rank FROM p)
SELECT doc_id, lang, part, CAST((rank - 1) // 32 AS BIGINT) AS batch, CAST((rank - 1) % 32 AS BIGINT) AS slot FROM r
""",
)
def _(spark, sf):
    return readers.to_batches(table(spark, sf, "documents").select("doc_id", "lang"), 32, "doc_id", "b")


# ---- catalog ----------------------------------------------------------------------------------------------------------

_WIDTH = {"BIGINT": 8, "INTEGER": 4, "DOUBLE": 8, "TIMESTAMP": 8}
_SCHEMAS = {
    "documents": [("doc_id", "BIGINT"), ("text", "S"), ("lang", "S"), ("source", "S"), ("n_chars", "BIGINT")],
    "labels": [("doc_id", "BIGINT"), ("quality", "INTEGER"), ("toxic", "INTEGER")],
    "pages": [("page_id", "BIGINT"), ("url", "S"), ("html", "S")],
    "customer": [("c_custkey", "BIGINT"), ("c_name", "S"), ("c_nationkey", "INTEGER"), ("c_acctbal", "DOUBLE"), ("c_mktsegment", "S")],
    "embeddings": [("vec_id", "BIGINT"), ("embedding", "F"), ("label", "INTEGER")],
    "orders": [
        ("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "S"), ("o_totalprice", "DOUBLE"),
        ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "S"),
    ],
    "region": [("r_regionkey", "INTEGER"), ("r_name", "S")],
    "nation": [("n_nationkey", "INTEGER"), ("n_name", "S"), ("n_regionkey", "INTEGER")],
    "supplier": [("s_suppkey", "BIGINT"), ("s_name", "S"), ("s_nationkey", "INTEGER"), ("s_acctbal", "DOUBLE")],
    "part": [("p_partkey", "BIGINT"), ("p_name", "S"), ("p_brand", "S"), ("p_type", "S"), ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE")],
    "lineitem": [
        ("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"), ("l_linenumber", "INTEGER"), ("l_quantity", "DOUBLE"),
        ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"), ("l_returnflag", "S"), ("l_linestatus", "S"), ("l_shipdate", "TIMESTAMP"),
    ],
    "events": [("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"), ("event_type", "S"), ("value", "DOUBLE"), ("props", "S")],
    "benchmark": [("item_id", "BIGINT"), ("text", "S")],
    "conversations": [("conv_id", "BIGINT"), ("turn", "BIGINT"), ("role", "S"), ("text", "S")],
}


def _bytes(column: str, kind: str) -> str:
    if kind == "S":
        return f"coalesce(sum(strlen({column})), 0)"
    if kind == "F":
        return f"coalesce(sum(len({column})), 0) * 4"
    return f"count({column}) * {_WIDTH[kind]}"


@register(
    "dataset_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {len(cols)}::BIGINT AS n_columns, count(*) AS n_rows, "
        f"CAST({' + '.join(_bytes(*c) for c in cols)} AS BIGINT) AS bytes FROM {name}"
        for name, cols in _SCHEMAS.items()
    ),
)
def _(spark, sf):
    return catalog.dataset_profile({name: table(spark, sf, name) for name in _SCHEMAS})


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "TIMESTAMP": "timestamp", "S": "string"}


@register(
    "column_profile",
    " UNION ALL ".join(
        f"SELECT {i + 1}::BIGINT AS position, '{c}' AS \"column\", '{_TYPES[k]}' AS type, count(*) - count({c}) AS nulls FROM orders"
        for i, (c, k) in enumerate(_SCHEMAS["orders"])
    ),
)
def _(spark, sf):
    return catalog.column_profile(
        table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    )


@register(
    "field_paths",
    f"""
WITH {PARTS}
SELECT 'id' AS path, 'bigint' AS type, count(id) AS elements FROM parts UNION ALL
SELECT 'tags', 'array<struct<value:string>>', count(tags) FROM parts UNION ALL
SELECT 'tags.element', 'struct<value:string>', CAST(sum(len(tags)) AS BIGINT) FROM parts UNION ALL
SELECT 'tags.value', 'string', CAST(sum(len(tags)) AS BIGINT) FROM parts
""",
)
def _(spark, sf):
    return catalog.field_paths(tagged_parts(spark, sf).select("id", nest_tags(F.col("tags")).alias("tags")))


@register(
    "dataset_size",
    "WITH s AS (SELECT count(*) AS n, "
    + ", ".join(f"CAST({_bytes(*c)} AS BIGINT) AS {c[0]}" for c in _SCHEMAS["documents"])
    + " FROM documents), r AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS bytes FROM s" for c, _ in _SCHEMAS["documents"])
    + " UNION ALL SELECT '(total)', " + " + ".join(c for c, _ in _SCHEMAS["documents"]) + " FROM s"
    + " UNION ALL SELECT '(dense)', n * 15000 * 8 FROM s) "
    + 'SELECT "column", CAST(bytes AS BIGINT) AS bytes, round(bytes / 1073741824.0::DOUBLE, 6) AS gib FROM r',
)
def _(spark, sf):
    return rounded(catalog.dataset_size(table(spark, sf, "documents"), 15000))


def _top(c: str, text: str) -> str:
    counted = f"(SELECT {text} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c})"
    return f"(SELECT v FROM {counted} ORDER BY n DESC, v LIMIT 1) AS top, (SELECT max(n) FROM {counted}) AS top_n"


def _number_stats(c: str, text: str) -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, count(*) FILTER ({c} = 0) AS zeros,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
  NULL::DOUBLE AS avg_length, count(DISTINCT {c}) AS "distinct", {_top(c, text)}, round(median({c}), 4) AS median FROM lineitem"""


def _other_stats(c: str, text: str, length: str) -> str:
    return f"""
SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, 0::BIGINT AS zeros,
  NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max, {length} AS avg_length,
  count(DISTINCT {c}) AS "distinct", {_top(c, text)}, NULL::DOUBLE AS median FROM lineitem"""


_LINE_NUMBERS = {"l_orderkey": "", "l_partkey": "", "l_suppkey": "", "l_linenumber": "", "l_quantity": "", "l_extendedprice": "", "l_discount": "", "l_tax": ""}
_LINE_TEXTS = ["l_returnflag", "l_linestatus"]
_STATS_SQL = [_number_stats(c, f"CAST({c} AS VARCHAR)") for c in _LINE_NUMBERS]
_STATS_SQL += [_other_stats(c, c, f"round(avg(length({c})), 4)") for c in _LINE_TEXTS]
_STATS_SQL += [_other_stats("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", "NULL::DOUBLE")]


@register("column_stats", " UNION ALL ".join(_STATS_SQL))
def _(spark, sf):
    return rounded(catalog.column_stats(table(spark, sf, "lineitem")), "mean", "std", "median", "avg_length", digits=4)


@register(
    "value_histogram",
    """
WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
x AS (SELECT CAST(least(floor((l_extendedprice - lo) * 10 / (hi - lo)), 9) AS BIGINT) AS bin FROM lineitem, b)
SELECT bin, round(min(lo + bin * (hi - lo) / 10), 6) AS low, round(min(lo + (bin + 1) * (hi - lo) / 10), 6) AS high, count(*) AS n
FROM x, b GROUP BY bin
""",
)
def _(spark, sf):
    return rounded(catalog.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10))


@register("preview", "SELECT *, (SELECT count(*) FROM customer) AS n_rows FROM customer ORDER BY c_custkey LIMIT 20")
def _(spark, sf):
    n_rows, head, _ = catalog.preview(table(spark, sf, "customer"), 20, "c_custkey")
    return head.withColumn("n_rows", F.lit(n_rows).cast("bigint"))


# ---- projections and filters --------------------------------------------------------------------------------------------


@register("project", "SELECT o_orderkey, o_orderpriority FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")


@register("project_except", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").drop("o_totalprice", "o_orderdate")


@register("filter_tag_equals", "SELECT doc_id, n_chars FROM documents WHERE lang = 'en'")
def _(spark, sf):
    return table(spark, sf, "documents").filter(F.col("lang") == "en").select("doc_id", "n_chars")


@register("filter_non_empty", "SELECT conv_id, turn, role FROM conversations WHERE text <> ''")
def _(spark, sf):
    return table(spark, sf, "conversations").filter(F.col("text") != "").select("conv_id", "turn", "role")


IDS = list(range(0, 450, 10))


@register("filter_in_list", f"SELECT doc_id, lang, source FROM documents WHERE doc_id IN ({', '.join(map(str, IDS))})")
def _(spark, sf):
    return aggregates.with_ids(table(spark, sf, "documents").select("doc_id", "lang", "source"), IDS, "doc_id")


@register("filter_in_table", "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, sf):
    toxic = table(spark, sf, "labels").filter("toxic = 1")
    return aggregates.with_ids(table(spark, sf, "documents").select("doc_id", "lang", "source"), toxic, "doc_id")


@register(
    "filter_year_range",
    "SELECT * FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1) WHERE year > 1995 AND year < 2001",
)
def _(spark, sf):
    per_year = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return per_year.filter((F.col("year") > 1995) & (F.col("year") < 2001))


@register(
    "filter_param_range",
    f"SELECT run_id, max_depth, round(test_score, 6) AS test_score FROM ({SCORES_SQL}) WHERE max_depth BETWEEN 3 AND 12 AND cv_folds = 3",
)
def _(spark, sf):
    kept = aggregates.in_ranges(score_log(spark, sf), {"max_depth": (3, 12)}).filter("cv_folds = 3")
    return rounded(kept).select("run_id", "max_depth", "test_score")


@register("sample_fraction", f"SELECT event_id, user_id FROM events WHERE {sql_bucket('event_id', 10000, 'sample')} < 500")
def _(spark, sf):
    return splits.hash_sample(table(spark, sf, "events").select("event_id", "user_id"), 0.05, "event_id")


@register(
    "hash_split",
    f"SELECT doc_id, CASE WHEN {sql_bucket('doc_id')} < 20 THEN 'eval' ELSE 'train' END AS split FROM documents",
)
def _(spark, sf):
    train, held = splits.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 20)
    return train.withColumn("split", F.lit("train")).unionByName(held.withColumn("split", F.lit("eval")))


@register("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(1000)


@register(
    "keep_if_all_tags_in",
    f"WITH {PARTS} SELECT id, p_brand FROM parts WHERE len(list_filter(tags, lambda t: t NOT IN ({sql_list(COLOURS + ['PROMO', 'LARGE', 'SMALL'])}))) = 0",
)
def _(spark, sf):
    return all_tags_in(tagged_parts(spark, sf), COLOURS + ["PROMO", "LARGE", "SMALL"]).select("id", "p_brand")


@register("to_model_frame", f"WITH {POSTS} SELECT id, tags[1] AS label, title || body AS text FROM posts")
def _(spark, sf):
    return to_model_frame(posts(spark, sf), ["title", "body"])


@register(
    "union_by_name",
    """
SELECT c_custkey AS run_id, c_acctbal AS test_score, NULL::VARCHAR AS alpha FROM customer UNION ALL
SELECT s_suppkey, s_acctbal, s_name FROM supplier
""",
)
def _(spark, sf):
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_acctbal").alias("test_score"))
    new = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("run_id"), F.col("s_acctbal").alias("test_score"), F.col("s_name").alias("alpha")
    )
    return sinks.union_scores(old, new)


@register(
    "distinct_params",
    """
SELECT o_custkey, o_orderstatus, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1
""",
)
def _(spark, sf):
    log = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority")
    return splits.dedupe(log, ["o_custkey", "o_orderstatus"], "o_orderkey")

