"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and the multiset of normalized values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute(f"SET TimeZone='{os.environ.get('ORACLE_TZ', 'UTC')}'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        v = v.item()
        if isinstance(v, int) and not isinstance(v, bool):
            return v
    return v


def rows_of(pdf):
    import pandas as pd

    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(None if (not isinstance(x, (list, tuple)) and pd.isna(x)) else _norm(x)
                         for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in sqls:
                results[name] = {"ok": None, "rows": len(sdf)}
                continue
            ddf = con.execute(sqls[name]).df()
            t2 = time.time()
            sc, sr = rows_of(sdf)
            dc, dr = rows_of(ddf)
            ok = sc == dc and sr == dr
            info = {"ok": ok, "rows": (len(sr), len(dr)), "spark_s": round(t1 - t0, 2),
                    "duck_s": round(t2 - t1, 2)}
            if not ok:
                info["cols"] = (sc, dc)
                diff_s = [r for r in sr if r not in set(dr)][:2]
                diff_d = [r for r in dr if r not in set(sr)][:2]
                info["only_spark"] = diff_s
                info["only_duck"] = diff_d
        except Exception as exc:  # report and go on
            info = {"ok": False, "error": f"{type(exc).__name__}: {str(exc)[:800]}"}
        results[name] = info
        if verbose:
            print(name, info, flush=True)
    return results


if __name__ == "__main__":
    from triage.session import builder

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = builder("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")
