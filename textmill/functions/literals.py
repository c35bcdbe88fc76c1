"""SQL text of literals.

Wide expressions (one entry per class, letter or word) are written as one SQL string: building them column by column
costs a driver round trip per entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value: str | int | float | bool) -> str:
    """SQL text of a Python scalar."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        if math.isinf(value) or math.isnan(value):
            return f"double('{value}')"
        return f"{value!r}D"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_array(values: Iterable) -> str:
    return f"array({', '.join(sql_literal(v) for v in values)})"


def literal_list(values: Iterable) -> Column:
    """Array column of literals; without values an empty string array."""
    values = list(values)
    return F.expr(sql_array(values)) if values else F.expr("cast(array() as array<string>)")


def literal_pairs(pairs: Iterable[tuple[str, str]]) -> Column:
    """Array of (f, t) structs."""
    return F.expr(
        "array(" + ", ".join(f"named_struct('f', {sql_literal(a)}, 't', {sql_literal(b)})" for a, b in pairs) + ")"
    )


def replace_all(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replace every first entry by its second, pair after pair."""
    return F.aggregate(literal_pairs(pairs), text, lambda acc, p: F.replace(acc, p["f"], p["t"]))
