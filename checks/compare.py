"""Runs registered queries beside their SQL text and compares every value; for development and tests."""

from __future__ import annotations

import math
import time
from decimal import Decimal


def normal(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, duck, name, fn, sql, sf_dir):
    """(ok, message, spark seconds)"""
    start = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL text", took
    cur = duck.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {set(got_cols) ^ set(want_cols)}", took
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}", took
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        diff = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return False, f"{len(bad)} of {len(got)} rows differ, first {diff[:4]}", took
    return True, f"{len(got)} rows equal", took


def duck_with_tables(sf_dir, tables):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
