"""Compare named queries with their SQL: ``python tests/check.py [name ...]``.

A name may be a prefix. ``SF_DIR`` selects the data.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (list, tuple)):
        return str([normal(v) for v in value])
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


TIMES = {"spark": 0.0}


def oracle(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(con, spark, folder, fn, sql):
    """None when equal, else a message."""
    df = fn(spark, folder)
    start = time.time()
    got = rows_of(df.columns, df.collect())
    TIMES["spark"] = time.time() - start
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"rows {len(got)} vs {len(want)}\n   spark {str(extra)[:600]}\n   sql   {str(missing)[:600]}", len(got)
    return None, len(got)


if __name__ == "__main__":
    from tagspark.plans.catalog import ORACLES, QUERIES
    from tagspark.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    con = oracle(folder)
    wanted = sys.argv[1:]
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            message, n = compare(con, spark, folder, fn, ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            message, n = f"{type(e).__name__}: {str(e)[:900]}", -1
        mark = "ok  " if message is None else "FAIL"
        kind = "sql" if name in ORACLES else "rows"
        bad += message is not None
        print(f"{mark} {name:40s} {kind:4s} {n:7d} rows {time.time() - start:6.2f}s spark {TIMES['spark']:6.2f}s", flush=True)
        if message:
            print("   " + message, flush=True)
    print("failed:", bad)
    sys.exit(bad > 0)
