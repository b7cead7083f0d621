"""Runs queries on Spark and their SQL on DuckDB and compares the results by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from catalog import ORACLES, QUERIES  # noqa: E402
from catalog.views import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() and abs(value) < 1e15 else float(f"{value:.10g}")
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = tuple(columns[i] for i in order)
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """(problem or None, row count, seconds)."""
    began = time.monotonic()
    df = QUERIES[name](spark, sf_dir)
    got = canonical(df.columns, df.collect())
    spent = time.monotonic() - began
    if name not in ORACLES:
        return None, len(got[1]), spent
    result = con.execute(ORACLES[name])
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}", len(got[1]), spent
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}", len(got[1]), spent
    for mine, theirs in zip(got[1], want[1]):
        if mine != theirs:
            return f"{mine} instead of {theirs}", len(got[1]), spent
    return None, len(got[1]), spent


if __name__ == "__main__":
    from tallyloom.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(QUERIES)
    session, connection = local_session("oracle-check"), duck(sf)
    bad = 0
    for query_name in chosen:
        try:
            problem, count, seconds = compare(session, connection, query_name, sf)
        except Exception as error:
            problem, count, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        bad += problem is not None
        mark = "-" if query_name not in ORACLES else "="
        print(f"{'FAIL' if problem else 'ok':4} {mark} {query_name:28} {count:8} rows "
              f"{seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
