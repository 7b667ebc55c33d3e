"""Run queries() against oracle_sql() on one scale factor and report matches.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from learnscope.session import local_session

    if os.environ.get("ORACLE_PLAIN_SESSION"):  # a session like the driver's: no tuning, default heap
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8") \
            .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session()
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok = bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in os_:
            print(f"{k:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(os_[k])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = frame_hash(srows, scols)
        ho, lo = frame_hash(orows, ocols)
        same = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        if same:
            ok += 1
            print(f"{k:28s} OK rows={len(srows)} {ts:.1f}s")
        else:
            bad += 1
            print(f"{k:28s} MISMATCH spark={len(srows)} {sorted(scols)} oracle={len(orows)} {sorted(ocols)}")
            a, b = set(ls) - set(lo), set(lo) - set(ls)
            for x in sorted(a)[:3]:
                print("   spark only :", x[:400])
            for x in sorted(b)[:3]:
                print("   oracle only:", x[:400])
    print(f"OK {ok}  BAD {bad}")


if __name__ == "__main__":
    main(sys.argv)
