"""URL filters: a temporal join of captures with dated list entries.

Entries (kind, pattern, action, dated) of one pattern follow one another: each is valid until the next one, so the list
becomes validity intervals. A capture offers the patterns that may match it (its host, the domains above it, the prefixes of
its path), and an as-of join finds the interval that holds its fetch time. Intervals are also cut at the borders of fixed
periods and the join is on (kind, pattern, period), so the entries of a pattern with a long history are not all compared
with every capture of a hot host; the optimizer may split that host's captures. The longest matching pattern decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textmill.llm.common import table
from textmill.staging import stage

PERIOD_SECONDS = 30 * 86_400
#: Of entries with equal kind, pattern and date this order decides.
ACTIONS = ("block", "allow", "remove")


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


def path_of(url: Column) -> Column:
    """Path without query and fragment, from the first slash behind the host; empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """All (kind, pattern, length) that may match a URL: host, domains of two labels or more, path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")

    def entry(kind: str, pattern: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"), F.length(pattern).alias("length"))

    domains = F.transform(
        F.when(F.size(labels) >= 2, F.sequence(F.lit(1), F.size(labels) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: entry("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    prefixes = F.transform(
        F.when(F.size(segments) >= 1, F.sequence(F.lit(1), F.size(segments))).otherwise(F.array().cast("array<int>")),
        lambda i: entry("prefix", F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/"))),
    )
    return F.when(host.isNotNull(), F.concat(F.array(entry("host", host)), domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """``kind``, ``pattern``, ``action``, ``valid_from``, ``valid_to`` (null: still valid) of block and allow entries.

    ``entries``: kind, pattern, action, dated (seconds). Entries with a null anywhere or an unknown action are left out; of
    entries at one time the first of ACTIONS decides.
    """
    order = F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action"))
    known = entries.where(F.col("kind").isNotNull() & F.col("pattern").isNotNull() & F.col("dated").isNotNull() & (order > 0))
    single = known.groupBy("kind", F.lower("pattern").alias("pattern"), "dated").agg(F.min_by("action", order).alias("action"))
    following = F.lead("dated").over(W.partitionBy("kind", "pattern").orderBy("dated"))
    return single.select("kind", "pattern", "action", F.col("dated").alias("valid_from"), following.alias("valid_to")).where("action <> 'remove'")


def evaluate(captures: DataFrame, entries: DataFrame, period: int = PERIOD_SECONDS) -> DataFrame:
    """All columns of ``captures`` plus ``verdict``, ``matched_kind``, ``matched_pattern``, ``valid_from``.

    ``captures`` holds ``url`` and ``fetched_s`` (seconds). Without a match, or with a null or hostless URL or a null time,
    the verdict is ``none``. The longest pattern decides; of a host and a domain of equal length, the host. Repeated
    captures are evaluated once and kept all; columns with the names of the results are replaced.
    """
    results = ("verdict", "matched_kind", "matched_pattern", "valid_from")
    base = captures.drop(*results)
    wanted = base.where(F.col("url").isNotNull() & F.col("fetched_s").isNotNull()).select("url", "fetched_s").distinct()
    offers = wanted.select("url", "fetched_s", F.explode(patterns_of(F.col("url"))).alias("p")).select(
        "url", "fetched_s", "p.*", F.expr(f"fetched_s div {int(period)} - IF(fetched_s % {int(period)} < 0, 1, 0)").alias("period")
    )
    valid = stage(intervals(entries), "intervals")
    # one number: entries without an end are cut into periods up to the last capture
    last = F.greatest(F.col("valid_from"), base.agg(F.max("fetched_s").alias("m")).scalar())
    end = F.coalesce(F.col("valid_to") - 1, last)
    cut = valid.where(F.col("valid_from") <= end).withColumn(
        "period", F.explode(F.sequence(F.floor(F.col("valid_from") / period), F.floor(end / period)))
    )
    inside = (F.col("fetched_s") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_s") < F.col("valid_to")))
    hits = offers.join(cut, ["kind", "pattern", "period"]).where(inside)
    rank = F.struct("length", (F.col("kind") == "host").cast("int").alias("h"), "kind", "pattern")
    best = hits.groupBy("url", "fetched_s").agg(F.max_by(F.struct("action", "kind", "pattern", "valid_from"), rank).alias("b"))
    decided = best.select(
        F.col("url").alias("__url"), F.col("fetched_s").alias("__time"), F.col("b.action").alias("verdict"),
        F.col("b.kind").alias("matched_kind"), F.col("b.pattern").alias("matched_pattern"), F.col("b.valid_from").alias("valid_from"),
    )
    joined = base.join(decided, (F.col("url") == F.col("__url")) & (F.col("fetched_s") == F.col("__time")), "left").drop("__url", "__time")
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit("none")))


# -- the query: captures and a dated list derived from the pages -----------------------------------------------------------

START_S = 1_704_067_200  # 2024-01-01
YEAR_MINUTES = 525_600


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures of the year 2024, at a minute that depends on the id."""
    minute = F.pmod(F.col("page_id") * 7919, F.lit(YEAR_MINUTES))
    return pages.select("page_id", "url", (START_S + minute * 60).alias("fetched_s"))


def _mix(text: Column, n: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % n


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and first path segments of the pages."""
    url = F.col("url")
    host, segment = host_of(url), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    named = pages.select(host.alias("host"), segment.alias("segment")).where("host IS NOT NULL").distinct()
    hosts = named.select(F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.lit(4).alias("n"))
    domains = named.select(F.lit("domain").alias("kind"), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("pattern"), F.lit(3).alias("n"))
    prefixes = named.where("segment <> ''").select(F.lit("prefix").alias("kind"), F.concat("host", F.lit("/"), "segment").alias("pattern"), F.lit(2).alias("n"))
    listed = hosts.unionByName(domains).unionByName(prefixes).where("pattern <> ''").distinct()
    numbered = listed.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    key = F.concat("kind", F.lit("|"), "pattern", F.lit("|"), F.col("i").cast("string"))
    action = F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), (_mix(F.concat(key, F.lit("|a")), 3) + 1).cast("int"))
    return numbered.select("kind", "pattern", action.alias("action"), (START_S + _mix(key, YEAR_MINUTES) * 60).alias("dated"))


def page_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return evaluate(captures_of(pages), entries_of(pages))


PAGE_VERDICTS_SQL = r"""
WITH captures AS (
  SELECT page_id, url, 1704067200 + ((page_id * 7919) % 525600) * 60 AS fetched_s,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment,
    [s FOR s IN string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1), '/') IF s <> ''] AS segments
  FROM pages
),
listed AS (
  SELECT DISTINCT 'host' AS kind, host AS pattern, 4 AS n FROM captures WHERE host IS NOT NULL
  UNION SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+)$', 1), 3 FROM captures WHERE host IS NOT NULL AND regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> ''
  UNION SELECT 'prefix', host || '/' || segment, 2 FROM captures WHERE host IS NOT NULL AND segment <> ''
),
entries AS (
  SELECT kind, pattern, ['block', 'allow', 'remove'][1 + CAST(('0x' || substr(md5(kind || '|' || pattern || '|' || i || '|a'), 1, 8)) AS BIGINT) % 3] AS action,
    1704067200 + (CAST(('0x' || substr(md5(kind || '|' || pattern || '|' || i), 1, 8)) AS BIGINT) % 525600) * 60 AS dated
  FROM (SELECT kind, pattern, unnest(range(1, n + 1)) AS i FROM listed)
),
singles AS (
  SELECT kind, lower(pattern) AS pattern, dated, arg_min(action, list_position(['block', 'allow', 'remove'], action)) AS action
  FROM entries GROUP BY 1, 2, 3
),
valid AS (
  SELECT * FROM (SELECT kind, pattern, action, dated AS valid_from, lead(dated) OVER (PARTITION BY kind, pattern ORDER BY dated) AS valid_to FROM singles)
  WHERE action <> 'remove'
),
offers AS (
  SELECT page_id, fetched_s, 'host' AS kind, host AS pattern FROM captures WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, fetched_s, 'domain', array_to_string(string_split(host, '.')[i:], '.')
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS i FROM captures WHERE host IS NOT NULL)
  UNION ALL
  SELECT page_id, fetched_s, 'prefix', host || '/' || array_to_string(segments[1:i], '/')
  FROM (SELECT *, unnest(range(1, len(segments) + 1)) AS i FROM captures WHERE host IS NOT NULL)
),
hits AS (
  SELECT o.page_id, v.action AS verdict, v.kind AS matched_kind, v.pattern AS matched_pattern, v.valid_from,
    row_number() OVER (PARTITION BY o.page_id ORDER BY length(v.pattern) DESC, v.kind = 'host' DESC, v.kind DESC, v.pattern DESC) AS r
  FROM offers o JOIN valid v ON o.kind = v.kind AND o.pattern = v.pattern AND o.fetched_s >= v.valid_from AND (v.valid_to IS NULL OR o.fetched_s < v.valid_to)
)
SELECT c.page_id, c.url, c.fetched_s, coalesce(h.verdict, 'none') AS verdict, h.matched_kind, h.matched_pattern, h.valid_from
FROM captures c LEFT JOIN hits h ON c.page_id = h.page_id AND h.r = 1
"""
