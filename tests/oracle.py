"""Run registered queries beside their SQL in DuckDB and compare every value."""

from __future__ import annotations

import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, directory: str, build, sql: str, connection=None) -> tuple[str | None, int, float, float]:
    """(difference or None, rows, Spark seconds, DuckDB seconds)."""
    started = time.time()
    df = build(spark, directory)
    got = [tuple(r) for r in df.collect()]
    spark_time = time.time() - started
    connection = connection or connect(directory)
    started = time.time()
    relation = connection.sql(sql)
    want = relation.fetchall()
    duck_time = time.time() - started
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}", len(got), spark_time, duck_time
    a, b = _rows(df.columns, got), _rows(relation.columns, want)
    if a == b:
        return None, len(got), spark_time, duck_time
    in_a, in_b = set(a), set(b)
    left = [r for r in a if r not in in_b][:3]
    right = [r for r in b if r not in in_a][:3]
    names = sorted(df.columns)
    return f"{len(a)} vs {len(b)} rows\n  cols  {names}\n  spark {left}\n  duck  {right}", len(got), spark_time, duck_time
