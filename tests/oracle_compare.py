"""Run registered queries and their DuckDB oracle side by side and compare results.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
Compares row count, column names, and an order-insensitive multiset of normalised
rows (decimals/floats rounded to 6 places, dates and times as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return float(v)
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i].lower())
        idx = {c.lower(): i for i, c in enumerate(d_cols)}
        order_d = [idx[s_cols[i].lower()] for i in order_s]
        cs = Counter(tuple(norm(r[i]) for i in order_s) for r in s_rows)
        cd = Counter(tuple(norm(r[i]) for i in order_d) for r in d_rows)
        if cs != cd:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            problems.append(f"values differ: spark-only {only_s} duck-only {only_d}")
    return problems, t1 - t0, len(s_rows)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from salesmart.session import local_session
    spark = local_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        if name not in orc:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            problems, secs, n = compare(spark, con, name, qs[name], orc[name], sf_dir)
        except Exception as e:  # report and continue
            problems, secs, n = [f"error: {type(e).__name__}: {str(e)[:400]}"], 0, 0
        status = "ok" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{name:28s} {status:4s} rows={n:<7d} {secs:6.2f}s {'; '.join(problems)}", flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
