"""Runs queries next to their SQL and compares the rows: check.py [sf] [name prefix ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from entitymill.plans.catalogue import ORACLES, QUERIES  # noqa: E402
from entitymill.plans.registry import RAW  # noqa: E402
from entitymill.session import build_session  # noqa: E402


def _cell(value):
    if isinstance(value, float):
        return round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def kinds(rows):
    if not rows:
        return []
    found = []
    for i in range(len(rows[0])):
        seen = {type(r[i]).__name__ for r in rows if r[i] is not None}
        found.append("|".join(sorted(seen)))
    return found


def compare(spark, con, name, sf_dir):
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    data = df.collect()
    took = time.time() - started
    columns, got = rows_of(df.columns, data)
    if name not in ORACLES:
        return f"rows-only {len(got)}", took, bool(got)
    rel = con.execute(ORACLES[name])
    ocols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if columns != ocols:
        return f"COLUMNS {columns} != {ocols}", took, False
    if len(got) != len(want):
        return f"COUNT {len(got)} != {len(want)}", took, False
    for a, b in zip(got, want):
        if a != b:
            return f"VALUE\n    spark {a}\n    duck  {b}", took, False
    if kinds(got) != kinds(want):
        return f"TYPES {kinds(got)} != {kinds(want)}", took, False
    return f"ok {len(got)}", took, True


def main() -> int:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    spark = build_session("check")
    con = duckdb.connect()
    for table in RAW:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    bad = 0
    for name in names:
        try:
            message, took, good = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            message, took, good = f"ERROR {type(error).__name__}: {str(error)[:700]}", 0.0, False
        bad += not good
        if not good or os.environ.get("VERBOSE"):
            print(f"{'  ' if good else '!!'} {name:34s} {took:6.2f}s {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
