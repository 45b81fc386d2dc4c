"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from glossa.plans.registry import all_queries  # noqa: E402
from glossa.session import local_session  # noqa: E402
from glossa.sources.fixtures import TABLES, table_path  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, q, sf_dir):
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    t1 = time.time()
    if q.oracle is None:
        return "ROWS", len(s_rows), None, t1 - t0, ""
    rel = con.execute(q.oracle)
    d_names = [d[0] for d in rel.description]
    d_rows_raw = rel.fetchall()
    if sorted(d_names) != s_cols:
        return "SCHEMA", len(s_rows), len(d_rows_raw), t1 - t0, f"spark={s_cols} duck={sorted(d_names)}"
    idx = [d_names.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows_raw]
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    s_sorted, d_sorted = sorted(s_rows, key=key), sorted(d_rows, key=key)
    if s_sorted == d_sorted:
        return "OK", len(s_rows), len(d_rows), t1 - t0, ""
    diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
    return "MISMATCH", len(s_rows), len(d_rows), t1 - t0, f"cols={s_cols} first diffs={diff}"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duck_connect(sf_dir)
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            status, ns, nd, secs, info = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and go on
            status, ns, nd, secs, info = "ERROR", None, None, 0.0, repr(e)[:600]
        bad += status not in ("OK", "ROWS")
        print(f"{status:8s} {name:32s} spark={ns} duck={nd} {secs:6.2f}s {info}", flush=True)
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
