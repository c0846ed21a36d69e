"""Compare the registered queries with their SQL: ``python tests/check_oracle.py [sf] [names..]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(value) -> str:
    if value is None or value is pd.NA or value is pd.NaT or value != value:
        return "NULL"
    if hasattr(value, "year"):
        return str(value)[:10]
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        rows.append(tuple(cell(v) for v in row))
    return sorted(rows)


def compare(spark, sf_dir: str, name: str, query, sql: str | None) -> str:
    started = time.time()
    got = query(spark, sf_dir).toPandas()
    took = time.time() - started
    if sql is None:
        return f"rows-only {len(got)} {took:.1f}s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    started = time.time()
    want = con.execute(sql).fetchdf()
    sql_took = time.time() - started
    if sorted(got.columns) != sorted(want.columns):
        return f"MISMATCH columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a != b:
        left, right = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return f"MISMATCH rows {len(a)} vs {len(b)}\n   spark {str(left)[:700]}\n   sql   {str(right)[:700]}"
    return f"ok {len(a)} rows, spark {took:.1f}s, sql {sql_took:.1f}s"


if __name__ == "__main__":
    from papersieve.session import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:]
    session = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    for key, fn in entry.queries().items():
        if chosen and key not in chosen:
            continue
        try:
            print(f"{key}: {compare(session, f'/root/testdata/sf{sf}', key, fn, sqls.get(key))}", flush=True)
        except Exception as error:
            print(f"{key}: ERROR {type(error).__name__} {str(error)[:600]}", flush=True)
