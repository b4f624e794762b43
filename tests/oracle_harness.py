"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]

Comparison: row count, column names (sorted), and an order-insensitive
multiset of normalised rows (floats compared exactly, dates as ISO text).
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    report = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t_spark = time.time() - t0
        if name not in sqls:
            report[name] = {"rows": len(s_rows), "oracle": None}
            continue
        res = con.execute(sqls[name])
        d_cols = [c[0] for c in res.description]
        d_rows = res.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_rows = len(s_rows) == len(d_rows)
        ok_vals = ok_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
        report[name] = {
            "rows": len(s_rows),
            "oracle_rows": len(d_rows),
            "cols": ok_cols,
            "values": ok_vals,
            "sec": round(t_spark, 2),
        }
        if verbose:
            flag = "OK " if (ok_cols and ok_rows and ok_vals) else "BAD"
            print(f"{flag} {name:34s} rows={len(s_rows):7d}/{len(d_rows):7d} {t_spark:6.2f}s", flush=True)
            if not ok_cols:
                print("   spark cols:", s_cols, "\n   duck cols: ", d_cols)
            elif not ok_vals:
                a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
                print("   only spark:", list((a - b).items())[:3])
                print("   only duck: ", list((b - a).items())[:3])
    return report


if __name__ == "__main__":
    from daybook.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if "values" in v and not (v["values"] and v["rows"] == v["oracle_rows"])]
    print("FAILED:", bad if bad else "none")
