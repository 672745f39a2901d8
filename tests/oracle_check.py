"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and value-hash agreement.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    import __spark_entry__ as entry
    from catspark.session import local_session
    spark = local_session()
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for key in (wanted or list(qs)):
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{key:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if key not in sqls:
            print(f"{key:32s} rows={len(srows):8d} (no oracle) spark={ts:.1f}s")
            continue
        t1 = time.time()
        try:
            res = con.sql(sqls[key])
            dcols = res.columns
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{key:32s} DUCK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        td = time.time() - t1
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = (len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd)
        bad += not ok
        print(f"{key:32s} rows={len(srows):8d}/{len(drows):8d} cols={'ok' if sorted(scols) == sorted(dcols) else (scols, dcols)} "
              f"hash={'ok' if hs == hd else 'DIFF'} spark={ts:.1f}s duck={td:.1f}s")
        if not ok and sorted(scols) == sorted(dcols):
            sd, dd = set(ls), set(ld)
            print("   spark-only:", sorted(sd - dd)[:3])
            print("   duck-only: ", sorted(dd - sd)[:3])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
