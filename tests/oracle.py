"""Run registered queries beside their DuckDB text and compare whole results.

    python tests/oracle.py [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(value: object) -> object:
    """A value by type and text, so 1, 1.0 and '1' stay different."""
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("null", "") if math.isnan(value) else ("float", f"{value:.9g}")
    if isinstance(value, dt.datetime | dt.date):
        return ("time", str(value))
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, sf: str, name: str, query, sql: str | None) -> tuple[bool, str]:
    start = time.time()
    frame = query(spark, sf)
    got = [tuple(r) for r in frame.collect()]
    spent = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {spent:.2f}s"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}"
    left, right = rows_of(frame.columns, got), rows_of(names, want)
    if left == right:
        return True, f"{len(got)} rows, {spent:.2f}s"
    only_left = [r for r in left if r not in set(right)][:2]
    only_right = [r for r in right if r not in set(left)][:2]
    return False, f"{len(left)} vs {len(right)} rows {sorted(names)}\n   spark {only_left}\n   duck  {only_right}"


def main() -> int:
    from starling.plans.catalog import ORACLES, QUERIES
    from starling.session import get_session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf = args[at + 1]
        del args[at : at + 2]
    spark, con = get_session(), connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        try:
            ok, text = compare(spark, con, sf, name, fn, ORACLES.get(name))
        except Exception as error:
            ok, text = False, f"{type(error).__name__}: {str(error)[:700]}"
        bad += not ok
        print("\n" + ("ok   " if ok else "FAIL ") + name, text, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
