"""Catalog rows and column statistics, measured in one pass over each table where possible."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.aggregates import equal_width_hist
from textmill.staging import stage

# Bytes of one value of a fixed-width type.
FIXED_WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def rows_from(df: DataFrame, rows: Sequence[Sequence[tuple[str, Column]]]) -> DataFrame:
    """Turn the single row of an aggregate into several rows, one per list of (name, expression)."""
    structs = F.array(*[F.struct(*[value.alias(name) for name, value in row]) for row in rows])
    return df.select(F.explode(structs).alias("r")).select("r.*")


def column_bytes(name: str, kind: T.DataType) -> Column:
    """Bytes held by one column: fixed width times non-null values, UTF-8 bytes of strings, element bytes of arrays."""
    simple = kind.simpleString()
    if simple in FIXED_WIDTH:
        return F.count(name) * FIXED_WIDTH[simple]
    if isinstance(kind, T.ArrayType) and kind.elementType.simpleString() in FIXED_WIDTH:
        width = FIXED_WIDTH[kind.elementType.simpleString()]
        return F.coalesce(F.sum(F.array_size(name)), F.lit(0)) * width
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        lengths = F.aggregate(name, F.lit(0).cast("bigint"), lambda acc, v: acc + F.octet_length(v))
        return F.coalesce(F.sum(lengths), F.lit(0))
    text = F.col(name) if isinstance(kind, T.StringType) else F.to_json(F.struct(name))
    return F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("bigint")


def dataset_size(df: DataFrame, n_features: int | None = None) -> DataFrame:
    """(column, bytes) plus a '(total)' row, and with ``n_features`` a '(dense)' row: rows x features x 8 bytes.

    ``gib`` repeats the bytes in GiB.
    """
    sums = df.agg(F.count("*").alias("_rows"), *[column_bytes(f.name, f.dataType).alias(f.name) for f in df.schema])
    rows = [[("column", F.lit(f.name)), ("bytes", F.col(f.name).cast("bigint"))] for f in df.schema]
    total = reduce(lambda a, b: a + b, [F.col(f.name) for f in df.schema])
    rows.append([("column", F.lit("(total)")), ("bytes", total.cast("bigint"))])
    if n_features:
        rows.append([("column", F.lit("(dense)")), ("bytes", (F.col("_rows") * n_features * 8).cast("bigint"))])
    return rows_from(sums, rows).withColumn("gib", F.col("bytes") / F.lit(float(2**30)))


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n_columns, n_rows, bytes): one row."""
    size = reduce(lambda a, b: a + b, [column_bytes(f.name, f.dataType) for f in df.schema])
    return df.agg(F.count("*").alias("n_rows"), size.cast("bigint").alias("bytes")).select(
        F.lit(name).alias("table_name"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "n_rows", "bytes"
    )


def dataset_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table of a dataset."""
    profiles = [table_profile(df, name) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), profiles)


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, nulls): one row per column, one pass."""
    nulls = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in df.schema])
    rows = [
        [
            ("position", F.lit(i + 1).cast("bigint")),
            ("column", F.lit(f.name)),
            ("type", F.lit(f.dataType.simpleString())),
            ("nulls", F.col(f.name)),
        ]
        for i, f in enumerate(df.schema)
    ]
    return rows_from(nulls, rows)


def _paths(kind: T.DataType, prefix: str, value: Column) -> list[tuple[str, str, Column]]:
    """(path, type, count of non-null elements in one row) of a column and everything nested in it."""
    found = [(prefix, kind.simpleString(), F.when(value.isNull(), 0).otherwise(1).cast("bigint"))]
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            found += _paths(field.dataType, f"{prefix}.{field.name}", value.getField(field.name))
    elif isinstance(kind, T.ArrayType):
        found += _array_paths(kind.elementType, prefix, value)
    return found


def _getter(name: str):
    return lambda v: v.getField(name)


def _array_paths(kind: T.DataType, prefix: str, array: Column) -> list[tuple[str, str, Column]]:
    size = F.array_size(F.filter(array, lambda v: v.isNotNull())).cast("bigint")
    found = [(f"{prefix}.element", kind.simpleString(), F.coalesce(size, F.lit(0)).cast("bigint"))]
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            inner = F.transform(array, _getter(field.name))
            nested = f"{prefix}.{field.name}"
            present = F.array_size(F.filter(inner, lambda v: v.isNotNull())).cast("bigint")
            found.append((nested, field.dataType.simpleString(), F.coalesce(present, F.lit(0)).cast("bigint")))
            if isinstance(field.dataType, T.ArrayType):
                found += _array_paths(field.dataType.elementType, nested, F.flatten(inner))
            elif isinstance(field.dataType, T.StructType):
                found += _array_paths(field.dataType, nested, inner)[1:]
    elif isinstance(kind, T.ArrayType):
        found += _array_paths(kind.elementType, f"{prefix}.element", F.flatten(array))
    return found


def field_paths(df: DataFrame) -> DataFrame:
    """(path, type, elements): nested fields as dotted paths with the number of non-null values under each."""
    paths = [p for f in df.schema for p in _paths(f.dataType, f.name, F.col(f.name))]
    sums = df.agg(*[F.coalesce(F.sum(value), F.lit(0)).alias(f"_p{i}") for i, (_, _, value) in enumerate(paths)])
    rows = [
        [("path", F.lit(path)), ("type", F.lit(kind)), ("elements", F.col(f"_p{i}"))]
        for i, (path, kind, _) in enumerate(paths)
    ]
    return rows_from(sums, rows)


def _one_zero(name: str, kind: T.DataType) -> Column:
    """-0.0 and 0.0 are one value."""
    fractional = isinstance(kind, (T.FloatType, T.DoubleType))
    return F.when(F.col(name) == 0, F.lit(0).cast(kind)).otherwise(F.col(name)) if fractional else F.col(name)


def distinct_and_top(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, distinct, top, top_n) of the non-null values; ``top`` is the most frequent one as text, ties alphabetical.

    Each column is read alone and counted in its own type, so a value is combined before it moves and only distinct values are
    written as text.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    parts = []
    for c in cols:
        counted = df.select(_one_zero(c, kinds[c]).alias("value")).filter(F.col("value").isNotNull()).groupBy("value").agg(F.count("*").alias("n"))
        text = F.col("value").cast("string")
        first = F.min_by(text, F.struct(-F.col("n"), text))
        parts.append(counted.agg(F.count("*").alias("distinct"), first.alias("top"), F.max("n").alias("top_n")).select(F.lit(c).alias("column"), "*").filter("distinct > 0"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def medians(df: DataFrame, cols: Sequence[str], bins: int = 512) -> dict[str, float]:
    """Exact medians of numeric columns by narrowing value ranges; NaN and null are left out, a column without numbers too.

    A pass counts, for all open columns at once, how many values fall into each of ``bins`` equal ranges between two bounds, with the
    least and the largest value of each. The range with the middle values becomes the next bounds, until it holds one value. The
    driver sees ``bins`` rows a column and pass; no column is sorted or moved.
    """
    number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    infinite = float("inf")
    facts = df.agg(*[
        F.struct(
            F.count(v).alias("n"), F.count_if(v == -infinite).alias("below"), F.count_if(v == infinite).alias("above"),
            F.min(F.when(F.abs(v) != infinite, v)).alias("low"), F.max(F.when(F.abs(v) != infinite, v)).alias("high"),
        ).alias(f"_{i}") for i, v in enumerate(number.values())
    ]).first()
    found: dict[str, float] = {}
    still: dict[str, tuple[int, int, float, float]] = {}
    for c, fact in zip(cols, facts, strict=True):
        if not fact.n:
            continue
        # places of the two middle values, from 0; one place if the number of values is odd
        places = (fact.n - 1) // 2, fact.n // 2
        known = [-infinite if p < fact.below else infinite if p >= fact.n - fact.above else None for p in places]
        if None not in known:
            found[c] = sum(known) / 2
        elif known != [None, None]:
            found[c] = next(k for k in known if k is not None)
        else:
            still[c] = (*(p - fact.below for p in places), fact.low, fact.high)
    while still:
        cells = []
        for i, (c, (_, _, low, high)) in enumerate(still.items()):
            width = high / bins - low / bins
            place = F.least(F.floor((number[c] - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
            cells.append(F.when(number[c].between(low, high), F.struct(F.lit(i).alias("i"), F.greatest(place, F.lit(0)).cast("int").alias("bin"), number[c].alias("v"))))
        counted = df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.i", "x.bin")
        rows = counted.agg(F.count("*").alias("n"), F.min("x.v").alias("low"), F.max("x.v").alias("high")).collect()
        for i, (c, (first, second, _, _)) in enumerate(list(still.items())):
            before = 0
            for r in sorted((r for r in rows if r.i == i), key=lambda r: r.bin):
                if first < before + r.n:
                    if second >= before + r.n:  # the two middle values end this range and begin the next one
                        after = min((x for x in rows if x.i == i and x.bin > r.bin), key=lambda x: x.bin)
                        found[c] = (r.high + after.low) / 2
                    elif r.low == r.high:
                        found[c] = r.low
                    else:
                        still[c] = (first - before, second - before, r.low, r.high)
                    break
                before += r.n
            if c in found:
                del still[c]
    return found


def column_stats(df: DataFrame, cols: Sequence[str] | None = None, limit: int | None = None, order_by: str | None = None) -> DataFrame:
    """Overview per column: count, missing, zeros, mean, std, min, median, max, distinct, top value, string length.

    ``limit`` restricts the overview to the first rows, as a quick look does; by default the whole table counts. Numeric
    measures are null for text columns and the other way round. ``top`` is the most frequent value, ties alphabetical.
    """
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType for f in df.schema}
    source = df.select(*cols)
    if limit:
        source = stage((df.orderBy(order_by) if order_by else df).limit(limit).select(*cols), "head")
    aggs = []
    for c in cols:
        number = F.col(c).cast("double") if _is_number(kinds[c]) else F.lit(None).cast("double")
        text = F.col(c) if isinstance(kinds[c], T.StringType) else F.lit(None).cast("string")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.count_if(F.col(c).isNull()).alias("missing"),
                F.count_if(number == 0).alias("zeros"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("std"),
                F.min(number).alias("min"),
                F.max(number).alias("max"),
                F.avg(F.length(text)).alias("avg_length"),
            ).alias(c)
        )
    wide = source.agg(*aggs)
    rows = wide.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("r")).select("r.*")
    numeric = [c for c in cols if _is_number(kinds[c])]
    middle = source.sparkSession.createDataFrame(list(medians(source, numeric).items()) if numeric else [], "column string, median double")
    return rows.join(distinct_and_top(source, cols), "column", "left").join(middle, "column", "left")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram of a numeric column."""
    return equal_width_hist(df, col, bins)


def preview(df: DataFrame, n: int = 20, order_by: str | None = None) -> tuple[int, DataFrame, list[tuple[str, str]]]:
    """Row count, first rows, and column names with types."""
    head = (df.orderBy(order_by) if order_by else df).limit(n)
    return df.count(), head, df.dtypes
