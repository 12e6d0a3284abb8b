"""Run registered queries in Spark and DuckDB and compare the rows.

    python tests/compare.py [name prefix ...] [--sf 0.01]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
import traceback
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wardflow.queries import ORACLE, QUERIES  # noqa: E402
from wardflow.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return plain(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date, dt.timedelta, dt.time)):
        return str(v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def norm(columns, rows):
    idx = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in idx) for r in rows]
    return [columns[i] for i in idx], sorted(out, key=lambda r: tuple((x is None, type(x).__name__ if not isinstance(x, (int, float)) else "n", x if not isinstance(x, tuple) else repr(x)) for x in r))


def check(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    df = QUERIES[name](spark, folder)
    scols, srows = norm(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return None if srows else "no rows"
    cur = con.cursor()
    cur.execute(ORACLE[name])
    ocols, orows = norm([d[0] for d in cur.description], cur.fetchall())
    if scols != ocols:
        return f"columns {scols} != {ocols}"
    if not orows:
        return "no rows on either side" if not srows else f"{len(srows)} rows, oracle none"
    if len(srows) != len(orows):
        extra = [r for r in srows if r not in set(orows)][:2] if len(srows) < 20000 else []
        missing = [r for r in orows if r not in set(srows)][:2] if len(srows) < 20000 else []
        return f"rows {len(srows)} != {len(orows)}; extra {extra}; missing {missing}"
    bad = [(a, b) for a, b in zip(srows, orows) if a != b]
    if bad:
        return f"{len(bad)} of {len(orows)} rows differ; {scols}\n   spark  {bad[0][0]}\n   oracle {bad[0][1]}"
    return None


def main(argv: list[str]) -> int:
    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i : i + 2]
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(folder)
    argv = [a for a in argv if not a.startswith("-")]
    names = [n for n in QUERIES if not argv or any(n.startswith(p) for p in argv)]
    def one(n: str):
        t0 = time.time()
        try:
            problem = check(spark, con, n, folder)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
            if "--trace" in sys.argv:
                traceback.print_exc()
        return n, problem, time.time() - t0

    failed = 0
    with ThreadPoolExecutor(4) as pool:
        for n, problem, took in pool.map(one, names):
            failed += bool(problem)
            if problem or "-v" in sys.argv:
                print(f"{'FAIL' if problem else 'ok  '} {n} {took:.1f}s {problem or ''}{'' if n in ORACLE else ' (no oracle)'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
