"""Run registered queries with Spark and their oracle SQL with DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, sorted column names and the multiset of rows (floats rounded to
6 significant places, order-insensitive).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(name, scols, srows, dcols, drows):
    if sorted(scols) != sorted(dcols):
        return f"columns differ: spark={sorted(scols)} oracle={sorted(dcols)}"
    if len(srows) != len(drows):
        return f"row count spark={len(srows)} oracle={len(drows)}"
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in drows)
    if sc != dc:
        extra = list((sc - dc).items())[:3]
        missing = list((dc - sc).items())[:3]
        return f"values differ: spark-only={extra} oracle-only={missing}"
    return None


def main():
    import duckdb
    from starmart.session import build_session
    import __spark_entry__ as E

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and continue
            print(f"FAIL {name}: spark error {str(exc)[:400]}")
            bad += 1
            continue
        st = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {st:.1f}s")
            continue
        try:
            dcols, drows = duck_rows(con, sqls[name])
        except Exception as exc:
            print(f"FAIL {name}: oracle error {str(exc)[:400]}")
            bad += 1
            continue
        err = compare(name, scols, srows, dcols, drows)
        if err:
            bad += 1
            print(f"FAIL {name}: {err}")
        else:
            print(f"OK   {name}: {len(srows)} rows {st:.1f}s")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
