"""Compares catalogue queries with their DuckDB statements, row by row.

    python tests/compare.py [sf folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return ("num", f"{value:.6f}")
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return "nan" if isinstance(value, float) and math.isnan(value) else (
            "num", f"{value:.6f}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(canonical(v) for v in value)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, statement: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    start = time.time()
    ours = df.collect()
    spent = time.time() - start
    relation = con.execute(statement)
    columns, theirs = [c[0] for c in relation.description], relation.fetchall()
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(set(df.columns) ^ set(columns))}"
    a, b = bag(df.columns, ours), bag(columns, theirs)
    if a == b:
        return True, f"{len(ours)} rows (collect {spent:.2f}s)"
    return False, (f"{len(ours)} vs {len(theirs)} rows\n   only spark {list((a - b))[:2]}"
                   f"\n   only duckdb {list((b - a))[:2]}")


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from newsvault.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    todo, sqls, bad = queries(), oracle_sql(), 0
    for name in argv[1:] or todo:
        start = time.time()
        try:
            if name in sqls:
                ok, note = compare(spark, con, sf_dir, todo[name], sqls[name])
            else:
                ok, note = True, f"{todo[name](spark, sf_dir).count()} rows (no oracle)"
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {note}",
              flush=True)
    print("missing queries:", sorted(set(sqls) - set(todo)))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
