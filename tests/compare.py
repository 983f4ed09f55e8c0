"""Run queries against their SQL and compare rows, columns and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return str(value)


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(plain(r[i]) for i in order) for r in rows))


def spark_rows(df):
    return ordered(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(sql, folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    out = con.execute(sql)
    return ordered([d[0] for d in out.description], out.fetchall())


def check(spark, name, folder, queries, oracles):
    """None when equal or unchecked, else what differs."""
    columns, rows = spark_rows(queries[name](spark, folder))
    if name not in oracles:
        return None if rows else "no rows"
    want_columns, want = sql_rows(oracles[name], folder)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}"
    for got, exp in zip(rows, want):
        if got != exp:
            return f"{got} != {exp}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from sluice.session import local_session

    folder = sys.argv[1]
    spark = local_session(8)
    wanted = sys.argv[2:] or list(queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            problem = check(spark, name, folder, queries(), oracle_sql())
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in oracle_sql() else "rows"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}",
              flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} ok")
