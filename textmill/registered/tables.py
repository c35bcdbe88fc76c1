"""Views of the test tables as posts, tags, labels and scores, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import lexicon
from textmill.functions.text import fold_accents, tokenise

COLOURS = ["red", "blue", "hot", "ring", "bolt", "gear"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """documents as posts: id, title (first line), body, tags."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.element_at(F.split("text", "\n"), 1).alias("title"),
        F.col("text").alias("body"),
        F.array("lang", "source").alias("tags"),
    )


POSTS = """
posts AS (
  SELECT doc_id AS id, string_split(text, chr(10))[1] AS title, text AS body, [lang, source] AS tags FROM documents
)"""


def tagged_parts(spark: SparkSession, sf: str) -> DataFrame:
    """part names as tag arrays: id, tags."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.split("p_name", " "), F.array("p_type")).alias("tags"), "p_type", "p_brand"
    )


PARTS = """
parts AS (
  SELECT p_partkey AS id, list_concat(string_split(p_name, ' '), [p_type]) AS tags, p_type, p_brand FROM part
)"""


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_bucket(key: str, n: int = 100, seed: str = "") -> str:
    text = f"CAST({key} AS VARCHAR)" + (f" || '#{seed}'" if seed else "")
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {n})"


def sql_hash(key: str, seed: str = "") -> str:
    text = f"CAST({key} AS VARCHAR)" + (f" || '#{seed}'" if seed else "")
    return f"substr(md5({text}), 1, 8)"


def sql_fold(x: str) -> str:
    """Accents by the engine's own function, plus the letters and signs it leaves."""
    out = f"strip_accents(coalesce({x}, ''))"
    for letter, plain in (("ß", "ss"), ("©", "(c)"), ("·", "*"), ("æ", "ae"), ("œ", "oe")):
        out = f"replace({out}, '{letter}', '{plain}')"
    return out


def sql_strip_punct(x: str) -> str:
    words = f"string_split(regexp_replace({x}, '[[:punct:]\\s]+', ' ', 'g'), ' ')"
    kept = f"list_filter({words}, lambda w: length(w) > 1 AND NOT regexp_matches(w, '^[0-9]+$'))"
    return f"array_to_string({kept}, ' ')"


ENTITY_TOKEN_SQL = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|(?:https?://|www\.)[^\s<>]+|[0-9]+(?:[.,/][0-9]+)*\b"
    r"|[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
)


def sql_keep(t: str) -> str:
    words = sql_list(list(lexicon.STOP_WORDS) + list(lexicon.NUMBER_WORDS))
    return (
        f"(lower({t}) NOT IN ({words})"
        rf" AND NOT regexp_matches({t}, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}$')"
        rf" AND NOT regexp_matches(lower({t}), '^(?:https?://|www\.)')"
        rf" AND NOT regexp_matches({t}, '^[+~-]?[0-9]+(?:[.,/][0-9]+)*$')"
        rf" AND NOT regexp_matches({t}, '^[^\p{{L}}\p{{N}}]+$'))"
    )


def sql_lemma(t: str) -> str:
    low = f"lower({t})"
    known = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lexicon.LEMMAS.items())
    return (
        f"(CASE {low} {known} ELSE"
        f" CASE WHEN {low} LIKE '%ies' AND length({t}) > 4 THEN left({low}, length({t}) - 3) || 'y'"
        f" WHEN regexp_matches({low}, '(?:ss|x|ch|sh|zz)es$') AND length({t}) > 4 THEN left({low}, length({t}) - 2)"
        f" WHEN {low} LIKE '%s' AND length({t}) > 3 AND NOT regexp_matches({low}, '(?:ss|us|is|as)$')"
        f" THEN left({low}, length({t}) - 1) ELSE {low} END END)"
    )


def sql_lemmatise(x: str) -> str:
    tokens = f"regexp_extract_all({x}, '{ENTITY_TOKEN_SQL}')"
    kept = f"list_filter({tokens}, lambda t: {sql_keep('t')})"
    return f"array_to_string(list_transform({kept}, lambda u: {sql_lemma('u')}), ' ')"


def sql_clean(x: str) -> str:
    return sql_strip_punct(sql_lemmatise(sql_fold(x)))


def sql_entities(x: str) -> str:
    out = x
    for entity, char in lexicon.HTML_ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return out


def sql_visible(x: str) -> str:
    pattern = r"<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
    return f"regexp_replace(coalesce({x}, ''), '{pattern}', '', 'gis')"


def sql_block(x: str, tag: str) -> str:
    closed = rf"(regexp_replace({sql_visible(x)}, '<{tag}(\s[^>]*)?>', '</{tag}><{tag}>', 'gi') || '</{tag}>')"
    blocks = f"regexp_extract_all({closed}, '(?is)<{tag}>(.*?)</{tag}>', 1)"
    bare = rf"list_transform({blocks}, lambda b: regexp_replace(b, '<[A-Za-z/!][^>]*>', ' ', 'g'))"
    return sql_entities(f"array_to_string({bare}, ' ')")


def folded_words(text: Column) -> Column:
    """Lower-cased words of at least two characters, accents folded."""
    return tokenise(fold_accents(text), "words")


def sql_words(x: str) -> str:
    return rf"regexp_extract_all(lower({sql_fold(x)}), '\b\w\w+\b')"


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round double columns so that engines with another order of summation agree."""
    names = cols or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})
