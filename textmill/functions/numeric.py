"""Small numeric functions: hash buckets, years, vector distances, cost classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind_once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it.

    An expression used inside a lambda is otherwise computed again for every element of the array it runs over.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fingerprint(key: Column, seed: str = "") -> Column:
    """Eight hex digits of md5, a stable pseudo-random text per key."""
    text = key.cast("string") if not seed else F.concat(key.cast("string"), F.lit("#" + seed))
    return F.substring(F.md5(text), 1, 8)


def fingerprint_bucket(key: Column, n: int = 100, seed: str = "") -> Column:
    """Stable bucket 0..n-1 of a key."""
    return F.pmod(F.conv(fingerprint(key, seed), 16, 10).cast("bigint"), F.lit(n))


def year_of(ts: Column) -> Column:
    return F.year(ts)


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity of two equally long arrays; null when one of them is all zero."""
    return 1 - F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def distance(a: Column, b: Column, kind: str = "euclidean") -> Column:
    return {"euclidean": euclidean, "cosine": cosine_distance}[kind](a, b)


def cost_class(seconds: Column) -> Column:
    """Class of a measured run time."""
    return F.when(seconds >= 300, "TIME-ERROR2").when(seconds >= 60, "TIME-ERROR1").when(seconds < 60, "TIME-OK")


def max_probability(probabilities: Column) -> Column:
    """Largest entry of a probability array."""
    return F.array_max(probabilities)


def uniform(seed: int | None = None) -> Column:
    """Uniform random number per row."""
    return F.rand(seed)
