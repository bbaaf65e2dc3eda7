"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [--sf DIR] [name ...]
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

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    import __spark_entry__ as E
    from tranche.session import get_spark
    spark = get_spark(shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(a.sf)
    names = a.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, a.sf)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"\nFAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in orc:
            print(f"\nrows {n}: {len(rows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(orc[n])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"\nFAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        print(f"\n{'OK  ' if ok else 'FAIL'} {n}: spark {len(rows)} rows / duck {len(orows)} ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(ocols):
                print("   cols spark", sorted(cols), "\n   cols duck ", sorted(ocols))
            else:
                s1, s2 = set(l1), set(l2)
                print("   only spark:", sorted(s1 - s2)[:3])
                print("   only duck: ", sorted(s2 - s1)[:3])
    print(f"{bad} failing of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
