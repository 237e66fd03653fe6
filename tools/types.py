"""Compare the column types of every registered query with its DuckDB oracle.

usage: python tools/types.py [--sf /root/testdata/sf0.001] [key ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_DUCK = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "ShortType": "SMALLINT", "ByteType": "TINYINT",
    "DoubleType": "DOUBLE", "FloatType": "FLOAT", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
    "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    import duckdb
    from cinelake.registry import oracle_sql, queries
    from cinelake.session import build_session
    from tools.check import TABLES
    spark = build_session("local[4]")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{a.sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracle_sql()
    for k in a.keys or list(qs):
        df = qs[k](spark, a.sf)
        st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
        rel = con.sql(os_[k])
        dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        bad = {c: (st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt)) if st.get(c) != dt.get(c)}
        print(f"{k:28s} {'ok' if not bad else bad}")
    spark.stop()


if __name__ == "__main__":
    main()
