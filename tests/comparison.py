"""Run a named query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

SAMPLE = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_on(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def _value(value):
    return float(value) if isinstance(value, Decimal) else value


def as_bag(names, rows) -> tuple[list[str], Counter]:
    """Column names in order, and rows as a multiset under that order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    bag = Counter(tuple(_value(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], bag


def differences(frame, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    names, expected = as_bag(relation.columns, relation.fetchall())
    got_names, got = as_bag(frame.columns, frame.collect())
    found = [] if names == got_names else [f"columns {got_names} instead of {names}"]
    if got != expected:
        found.append(
            f"only in Spark {list((got - expected).items())[:3]}, "
            f"only in SQL {list((expected - got).items())[:3]}"
        )
    return found
