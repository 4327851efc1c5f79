"""Run every query next to its SQL and compare column names, row counts and values.

Usage: python tests/check_oracle.py SF_DIR [QUERY ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normalized(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    rows = [
        tuple(None if pd.isna(v) else round(v, 6) if isinstance(v, float) else v for v in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} and {len(sql_frame)} rows"
    left, right = normalized(spark_frame), normalized(sql_frame)
    for a, b in zip(left, right):
        if a != b:
            return f"{a} and {b}"
    return None


if __name__ == "__main__":
    from conftest import build_session

    spark, (sf_dir, *names) = build_session(), sys.argv[1:]
    con, oracle = connect(sf_dir), contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        result = query(spark, sf_dir)
        schema = result.schema.simpleString()
        frame = result.toPandas()
        taken = time.time() - start
        outcome = "no SQL"
        if name in oracle:
            start = time.time()
            relation = con.sql(oracle[name])
            types = dict(zip(relation.columns, map(str, relation.types)))
            sql_frame = relation.df()
            outcome = difference(frame, sql_frame) or "same"
            outcome += f" (SQL {time.time() - start:.1f} s) {types}"
        print(f"{name}: {len(frame)} rows, {taken:.1f} s, {outcome} | {schema}", flush=True)
