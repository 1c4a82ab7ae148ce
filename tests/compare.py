"""Runs a query on Spark and its statement on the check engine and compares the row sets."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def check_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _rows(columns, cursor.fetchall())


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text if both give the same columns and the same multiset of typed values, exactly."""
    columns, ours = spark_rows(df)
    expected_columns, theirs = sql_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    for row in theirs:
        for kind, value in row:
            if isinstance(value, Decimal) and value.as_tuple().exponent not in (-3, -2, -1, 0):
                return f"unexpected scale {kind} {value}"
    extra, missing = ours - theirs, theirs - ours
    if extra or missing:
        return f"only ours {list(extra)[:2]}; only theirs {list(missing)[:2]}; {sum(extra.values())} rows"
    return ""
