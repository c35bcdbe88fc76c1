"""Sinks, sources, the cleaning job and its stream."""

import glob
import random
import statistics

import pytest
from pyspark.sql import functions as F

from textmill.operators import catalog
from textmill.plans.clean import clean_posts, preprocess
from textmill.sources import readers, sinks
from textmill.streaming.clean_stream import RAW_POST, clean_post_stream, read_post_stream

POSTS = [
    (1, "Sorting Arrays", "<p>How do I sort?</p><pre><code>sort(x)</code></pre>", ["c#", "unknown", "java", "c#"]),
    (2, None, None, None),
    (3, "", "<p>one<p>two", []),
    (4, "Rails, really", "plain body", ["ruby-on-rails"]),
]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(POSTS, RAW_POST)


def test_clean_posts(posts):
    rows = {r.id: r for r in clean_posts(posts).collect()}
    assert rows[1].tags == ["c#", "java"]
    assert (rows[1].title, rows[1].text_body, rows[1].code_body) == ("sorting array", "sort", "sort")
    assert (rows[2].title, rows[2].text_body, rows[2].code_body, rows[2].tags) == ("", "", "", [])
    assert rows[3].text_body == ""
    assert rows[4].tags == ["ruby-on-rails"]


def test_preprocess_job(spark, posts, tmp_path):
    raw, table, text = f"{tmp_path}/raw", f"{tmp_path}/table", f"{tmp_path}/text"
    posts.write.parquet(raw)
    preprocess(spark, raw, table, text, partitions=2)
    clean = preprocess(spark, raw, table, text, partitions=2)
    assert clean.count() == 4
    for path in glob.glob(f"{text}/*.csv"):
        with open(path) as lines:
            assert lines.readline().rstrip("\n") == "id, title, text_body, code_body, tags"
    back = {r.id: r for r in readers.read_text_lines(spark, text, sinks.TEXT_HEADER).collect()}
    assert back["1"].tags == "c#-java" and back["1"].title == "sorting array"
    assert len(back) == 4


def test_text_line_prints_none(spark):
    df = spark.createDataFrame([(1, None, "a", "b", ["x", "y"])], "id int, title string, text_body string, code_body string, tags array<string>")
    assert sinks.to_text_lines(df).first()[0] == "1, None, a, b, x-y"


def test_write_modes(spark, tmp_path):
    df, path = spark.range(3), f"{tmp_path}/t"
    sinks.write_table(df, path, "new")
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_table(df, path, "new")
    sinks.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    sinks.write_table(df, path, "truncate")
    assert spark.read.parquet(path).count() == 3


def test_conform_rejects_null_in_required_field(spark):
    raw = spark.createDataFrame([(None, "t", "b", "c", None)], "id bigint, title string, text_body string, code_body string, tags array<string>")
    with pytest.raises(Exception, match="required field id"):
        readers.conform(raw).collect()
    fine = raw.withColumn("id", F.lit(1))
    assert readers.conform(fine).first().tags == []


def test_json_records(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert sinks.to_json_records(df).first()[0] == '{"a":1,"b":null}'


def test_stream_equals_batch(spark, posts, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    posts.repartition(3).write.parquet(raw)
    query = clean_post_stream(read_post_stream(spark, raw, 1), out, f"{tmp_path}/checkpoint")
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, clean_posts(posts).collect()))


def test_batches_keep_every_row(spark):
    df = readers.to_batches(spark.range(1000), 64, "id", "s", partitions=4)
    assert df.count() == 1000
    assert df.groupBy("part", "batch").count().agg(F.max("count")).first()[0] == 64


def test_medians(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 5.0), (4, None), (5, 9.0)], "a int, b double")
    assert catalog.medians(df, ["a", "b"]) == {"a": 3.0, "b": 3.5}


@pytest.mark.parametrize("bins", [2, 512])
def test_medians_of_any_values(spark, bins):
    rng, inf, nan = random.Random(bins), float("inf"), float("nan")
    lists = [
        [rng.choice([1e-300, 1e300, -1e308, 5.0, 5.0, 1e308, 0.1]) for _ in range(50)], [rng.gauss(0, 1) for _ in range(51)], [7.0] * 50, [-inf, inf, 1.0], [inf, inf, 1.0],
        [-inf, -inf, inf, inf], [nan, 3.0, nan], [0.0, -0.0], [1.0, 2.0], [float(2**53 + 2 * i) for i in range(7)], [nan], [],
    ]
    size = max(map(len, lists))
    rows = [tuple(x[i] if i < len(x) else None for x in lists) for i in range(size)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(lists)))).repartition(3)
    want = {}
    for i, values in enumerate(lists):
        numbers = sorted(v for v in values if v == v)
        if numbers:
            want[f"c{i}"] = pytest.approx(statistics.median(numbers)) if numbers[0] + numbers[-1] == numbers[0] + numbers[-1] else None
    got = catalog.medians(df, df.columns, bins)
    assert set(got) == set(want) and all(v is None or got[c] == v for c, v in want.items())
    assert got["c3"] == 1.0 and got["c4"] == inf


def test_column_stats_on_first_rows(spark):
    df = spark.range(100).withColumn("t", F.lit("xy"))
    rows = {r.column: r for r in catalog.column_stats(df, limit=10, order_by="id").collect()}
    assert rows["id"]["count"] == 10 and rows["id"]["max"] == 9.0 and rows["t"]["top"] == "xy"
    assert rows["t"]["avg_length"] == 2.0 and rows["id"]["median"] == 4.5


def test_preview(spark):
    n, head, kinds = catalog.preview(spark.range(30), 5, "id")
    assert n == 30 and head.count() == 5 and kinds == [("id", "bigint")]
