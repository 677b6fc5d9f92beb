"""Run named queries on Spark and their SQL twins on DuckDB and compare the rows exactly.

Usage: python tests/oracle.py [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SF = os.environ.get("LODESTAT_SF", "/root/testdata/sf0.01")


def connect(folder: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    return f"{type(v).__name__}:{v}"


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark, con, name, fn, sql, folder=SF) -> str:
    """Empty text when both sides agree."""
    df = fn(spark, folder)
    mine_cols, mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if mine else "no rows"
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want_cols, want = _rows(cols, rel.fetchall())
    if mine_cols != want_cols:
        return f"columns {mine_cols} and {want_cols}"
    if len(mine) != len(want):
        return f"rows {len(mine)} and {len(want)}"
    bad = [(a, b) for a, b in zip(mine, want) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from lodestat.session import local_session

    spark = local_session("oracle", 8)
    con = connect()
    sqls, parts, failed = oracle_sql(), sys.argv[1:], 0
    for name, fn in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, sqls.get(name))
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:300].replace(chr(10), ' ')}"
        took = time.time() - start
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {took:6.2f}s {name} {problem}", flush=True)
        failed += bool(problem)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
