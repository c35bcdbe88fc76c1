"""Run a registered query in Spark and its SQL twin in DuckDB and compare the rows.

Usage: python tests/harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"float:{round(value, 6) + 0.0:.6f}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}={cell(v)}" for k, v in value.items()) + "}"
    if hasattr(value, "asDict"):
        return cell(value.asDict())
    return f"{type(value).__name__}:{value}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(cell(r[i]) for i in order) for r in rows])


def compare(name: str, spark, sf: str, con=None) -> dict:
    from textmill.registered import QUERIES, SQL

    start = time.time()
    df = QUERIES[name](spark, sf)
    got_names, got = rows_of(df.columns, df.collect())
    spent = time.time() - start
    out = {"name": name, "rows": len(got), "spark_s": round(spent, 2), "status": "rows-only"}
    if name not in SQL:
        return out
    start = time.time()
    cursor = (con or connect(sf)).execute(SQL[name])
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    out["duck_s"] = round(time.time() - start, 2)
    if got_names != want_names:
        return out | {"status": "names differ", "detail": (got_names, want_names)}
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return out | {"status": "rows differ", "detail": (len(got), len(want), only_got, only_want)}
    return out | {"status": "ok" if got else "ok (empty)"}


def main() -> None:
    from textmill import build_session
    from textmill.registered import QUERIES, load_all

    load_all()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    names = [n for n in QUERIES if n in wanted or any(w.endswith("*") and n.startswith(w[:-1]) for w in wanted)]
    spark = build_session("harness", "local[8]", 8, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = []
    for name in names:
        try:
            result = compare(name, spark, sf, con)
        except Exception as exc:  # noqa: BLE001
            result = {"name": name, "status": "error", "detail": f"{type(exc).__name__}: {str(exc)[:1200]}"}
        if result["status"] not in ("ok", "rows-only"):
            bad.append(name)
        print(result, flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} fine; bad: {bad}")


if __name__ == "__main__":
    main()
