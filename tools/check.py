"""Run registered queries next to their SQL checks and report differences.

usage: python tools/check.py [-d FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vellum.plans import CHECKS, QUERIES  # noqa: E402
from vellum.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads=8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - start
    if name not in CHECKS:
        return True, f"rows {len(got[1])} (no SQL) {spent:.2f}s"
    start = time.time()
    cur = con.execute(CHECKS[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    text = f"rows {len(got[1])} spark {spent:.2f}s sql {time.time() - start:.2f}s"
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = set(map(repr, got[1])), set(map(repr, want[1]))
        only = f"\n  spark only {len(a - b)}: {sorted(a - b)[:3]}\n  sql only {len(b - a)}: {sorted(b - a)[:3]}"
        types = {k: (type(x), type(y)) for k, x, y in zip(got[0], got[1][0], want[1][0])} if got[1] and want[1] else {}
        return False, f"{text} want {len(want[1])}{only}\n  {[(k, v) for k, v in types.items() if v[0] != v[1]]}"
    return True, text


if __name__ == "__main__":
    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    session, db = local_session(), connection(args.d)
    session.sparkContext.setLogLevel("OFF")
    bad = []
    for q in args.names or list(QUERIES):
        try:
            ok, message = compare(session, db, args.d, q)
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "BAD ", q, message, flush=True)
        if not ok:
            bad.append(q)
    print(f"{len(bad)} bad: {bad}")
