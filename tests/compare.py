"""Run registered queries against their SQL in DuckDB and compare rows exactly.

python tests/compare.py [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DATA = os.environ.get("TIDEMARK_DATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads=4")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, case, sf_dir):
    """(spark rows, oracle rows, problem or None)."""
    df = case.query(spark, sf_dir)
    names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = case.oracle()
    if sql is None:
        return len(got), None, None
    cur = con.execute(sql)
    want_names, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return len(got), len(want), f"columns {names} vs {want_names}"
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        n = len(set(got) ^ set(want))
        return len(got), len(want), f"{n} rows differ\n   {names}\n   spark  {extra}\n   oracle {missing}"
    return len(got), len(want), None


def main(argv):
    from catalog.registry import CASES
    from tidemark.session import local_session

    sf = argv[0] if argv else "0.01"
    wanted = argv[1:] or list(CASES)
    sf_dir = f"{DATA}/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        t = time.time()
        try:
            n, m, problem = compare(spark, con, CASES[name], sf_dir)
        except Exception as e:  # report and go on
            n, m, problem = -1, -1, f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {n:>7} {m!s:>7} {time.time() - t:6.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
