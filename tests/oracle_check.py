"""Runs a query and its SQL side by side and tells how they differ."""

from __future__ import annotations

import math
import os

import duckdb


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isnan(a) and math.isnan(b) or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: float(v) if type(v).__name__ == "Decimal" else v
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), round(x, 6) if isinstance(x, float) else x) if not isinstance(x, bool) else (False, "b", x) for x in r))


def difference(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if both give the same columns and rows."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        t = name.removesuffix(".parquet")
        con.execute(f"create view {t} as select * from '{sf_dir}/{name}'")
    got = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in got.description], got.fetchall())
    df = query(spark, sf_dir)
    cols, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if cols != want_cols:
        return f"columns {cols} and {want_cols}"
    if len(rows) != len(want):
        return f"{len(rows)} rows and {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want, strict=True) if not all(map(same, a, b))]
    return f"{len(bad)} of {len(rows)} rows, such as {bad[0]}" if bad else ""
