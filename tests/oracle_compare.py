"""Compare a Spark query with its DuckDB SQL on the same parquet tables:
row count, column names and order-insensitive values (floats to 6 places)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        if isinstance(v, dt.datetime) and v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _canon(v.asDict())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def canon_rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_sec": round(t1 - t0, 2)}
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["values_match"] = False
        return out
    a, b = canon_rows(s_cols, s_rows), canon_rows(d_cols, d_rows)
    out["values_match"] = a == b
    if a != b:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out


if __name__ == "__main__":
    import os
    import tempfile
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from livetable.session import build_session
    from livetable.plans.queries import QUERIES
    from livetable.plans.oracle import ORACLE
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    keys = sys.argv[1:] or list(QUERIES)
    spark = build_session(checkpoint_dir=tempfile.mkdtemp(prefix="lt-ckpt-", dir="/tmp"))
    bad = 0
    for k in keys:
        if k not in ORACLE:
            t0 = time.time()
            n = QUERIES[k](spark, sf).count()
            print({"name": k, "rows_only": n, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, k, QUERIES[k], ORACLE[k], sf)
        except Exception as e:  # report and go on
            r = {"name": k, "error": repr(e)[:600]}
        ok = r.get("values_match") and r.get("spark_rows") == r.get("oracle_rows")
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(r), flush=True)
    print("failures:", bad)
