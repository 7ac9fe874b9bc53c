"""Run registered queries and their SQL side by side.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_columns, spark_rows, sql_columns, sql_rows) -> str | None:
    """None if both sides agree, else the first difference."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    a, b = _rows(spark_columns, spark_rows), _rows(sql_columns, sql_rows)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            same = u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1.01e-6))
            if not same:
                return f"{sorted(spark_columns)}\n   spark {x}\n   sql   {y}"
    return None


def exact(spark_columns, spark_rows, sql_columns, sql_rows) -> bool:
    """Every value the same to the last bit."""

    def bits(columns, rows):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted(repr(tuple(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i] for i in order)) for r in rows)

    return bits(spark_columns, spark_rows) == bits(sql_columns, sql_rows)


def run(spark, con, name: str, sf_dir: str, queries: dict, oracles: dict) -> tuple[str | None, int, float, bool]:
    began = time.time()
    df = queries[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - began
    if name not in oracles:
        return None, len(rows), took, True
    cur = con.execute(oracles[name])
    names = [d[0] for d in cur.description]
    got = cur.fetchall()
    return compare(df.columns, rows, names, got), len(rows), took, exact(df.columns, rows, names, got)


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    import __spark_entry__ as entry
    from fleetwatt.session import local_session

    spark, con = local_session(), connect(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in args.names or queries:
        try:
            problem, n, took, same = run(spark, con, name, args.sf, queries, oracles)
        except Exception as e:  # report and go on with the next query
            problem, n, took, same = f"{type(e).__name__}: {str(e)[:1500]}", 0, 0.0, False
            if os.environ.get("TRACE"):
                traceback.print_exc()
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {kind:4s} rows={n:<7d} {took:6.2f}s{'' if same else ' (inexact)'}{'' if problem is None else '  ' + problem}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")


if __name__ == "__main__":
    main()
