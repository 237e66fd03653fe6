"""Run registered queries and their DuckDB oracles side by side and compare
row count, column names and an order-insensitive hash of the values.

usage: python tools/check.py [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    import duckdb
    from cinelake.registry import oracle_sql, queries
    from cinelake.session import build_session
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracle_sql()
    keys = a.keys or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in os_:
            print(f"{k:32s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(os_[k])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} ORACLE-ERROR {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        ok = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        bad += not ok
        print(f"{k:32s} {'OK  ' if ok else 'DIFF'} rows={len(srows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   cols spark:", sorted(scols), "\n   cols orcl:", sorted(ocols))
            only_s = sorted(set(ls) - set(lo))[:4]
            only_o = sorted(set(lo) - set(ls))[:4]
            print("   cols:", sorted(scols))
            for x in only_s:
                print("   spark :", x[:300])
            for x in only_o:
                print("   oracle:", x[:300])
    print("mismatches:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
