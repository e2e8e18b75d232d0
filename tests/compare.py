"""Run registered queries against their DuckDB oracle (same check as the driver's).

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from sentimill.session import get_spark  # noqa: E402
from sentimill.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    return repr(v)


def digest(rows):
    lines = sorted("|".join(_norm(v) for v in r) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark(master="local[8]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            cols = sorted(df.columns)
            srows = [tuple(r[c] for c in cols) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} SPARK-ERROR {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"{name:22s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(orc[name])
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} DUCK-ERROR {str(e)[:400]}")
            bad += 1
            continue
        idx = {c: i for i, c in enumerate(ocols)}
        if sorted(ocols) != cols:
            print(f"{name:22s} SCHEMA spark={cols} duck={sorted(ocols)}")
            bad += 1
            continue
        orows = [tuple(r[idx[c]] for c in cols) for r in orows]
        hs, ls = digest(srows)
        ho, lo = digest(orows)
        ok = hs == ho
        print(f"{name:22s} {'OK ' if ok else 'DIFF'} rows={len(srows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            bad += 1
            a, b = set(ls), set(lo)
            for x in list(a - b)[:3]:
                print("   spark:", x[:300])
            for x in list(b - a)[:3]:
                print("   duck :", x[:300])
    print("failures:", bad)


if __name__ == "__main__":
    main()
