"""Run registered queries in Spark and their oracle SQL in DuckDB; compare rows, columns, values.

usage: python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from sparkdesk.plans import registry  # noqa: E402
from sparkdesk.plans.tables import TABLES  # noqa: E402
from sparkdesk.session import local_session  # noqa: E402


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, sf_dir):
    t0 = time.time()
    sdf = registry.QUERIES[key](spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if key not in registry.ORACLES:
        return dict(key=key, rows=len(srows), oracle=None, spark_s=round(t1 - t0, 2))
    res = con.execute(registry.ORACLES[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    out = dict(key=key, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2),
               duck_s=round(t2 - t1, 2))
    if sorted(c.lower() for c in scols) != sorted(c.lower() for c in dcols):
        out["cols"] = (scols, dcols)
        return out
    si = sorted(range(len(scols)), key=lambda i: scols[i].lower())
    di = sorted(range(len(dcols)), key=lambda i: dcols[i].lower())
    sc = Counter(tuple(norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(norm(r[i]) for i in di) for r in drows)
    out["match"] = sc == dc
    if sc != dc:
        out["only_spark"] = list((sc - dc).items())[:3]
        out["only_oracle"] = list((dc - sc).items())[:3]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    registry.load_all()
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for key in keys or list(registry.QUERIES):
        try:
            r = compare(spark, con, key, sf_dir)
        except Exception as e:  # report and go on
            r = dict(key=key, error=f"{type(e).__name__}: {str(e)[:600]}")
        ok = r.get("match") or (r.get("oracle", 1) is None and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + repr(r)[:1500], flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
