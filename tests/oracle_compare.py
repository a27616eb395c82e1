"""Run registered Spark jobs and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Compares row count, column names and an order-insensitive value hash, the
way the correctness gate does.
"""

from __future__ import annotations

import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else format(v, "f").rstrip("0").rstrip(".")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def table_hash(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[k] = ("SPARK-ERROR", repr(e)[:400])
            print(k, "SPARK-ERROR", repr(e)[:2000], flush=True)
            continue
        t1 = time.time()
        if k not in sqls:
            results[k] = ("NO-ORACLE", len(s_rows))
            print(f"{k:40s} rows={len(s_rows)} (no oracle) spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sqls[k])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("DUCK-ERROR", repr(e)[:400])
            print(k, "DUCK-ERROR", repr(e)[:2000], flush=True)
            continue
        sh, sl = table_hash(s_cols, s_rows)
        dh, dl = table_hash(d_cols, d_rows)
        ok = (len(s_rows) == len(d_rows)) and sorted(s_cols) == sorted(d_cols) and sh == dh
        results[k] = ("OK" if ok else "MISMATCH", len(s_rows), len(d_rows))
        print(f"{k:40s} {'OK' if ok else 'MISMATCH'} rows={len(s_rows)}/{len(d_rows)} spark={t1 - t0:.1f}s",
              flush=True)
        if not ok and verbose:
            if sorted(s_cols) != sorted(d_cols):
                print("   cols spark:", s_cols, "\n   cols duck: ", d_cols)
            ds, dd = sorted(set(sl) - set(dl)), sorted(set(dl) - set(sl))
            print("   spark-only:", ds[:3], "\n   duck-only: ", dd[:3])
    return results


if __name__ == "__main__":
    from martwright.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    ks = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, ks)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")]
    print("FAILED:", bad if bad else "none")
