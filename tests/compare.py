"""Runs a query on Spark and its SQL on DuckDB and compares the rows as multisets."""

from __future__ import annotations

import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, float):
        return round(value, 6)
    return value


def _multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    result = connection.execute(sql)
    expected_columns = [item[0] for item in result.description]
    if sorted(expected_columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(expected_columns)}"
    expected = _multiset(expected_columns, result.fetchall())
    actual = _multiset(frame.columns, frame.collect())
    if actual == expected:
        return None
    extra, lost = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows instead of {sum(expected.values())};"
        f" not expected: {list(extra)[:2]}; not found: {list(lost)[:2]}"
    )
