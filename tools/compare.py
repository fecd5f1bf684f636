"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from strata.registry import REGISTRY
    from strata.session import build_session

    spark = build_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.run(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            scols, srows = canon(df.columns, rows)
        except Exception as e:  # report and go on
            bad += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            dcols, drows = canon(dcols, res.fetchall())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        if scols != dcols:
            bad += 1
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
        elif srows != drows:
            bad += 1
            diff_s = [r for r in srows if r not in set(drows)][:3]
            diff_d = [r for r in drows if r not in set(srows)][:3]
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)}\n  spark-only {diff_s}\n  duck-only {diff_d}")
        else:
            print(f"ok   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
