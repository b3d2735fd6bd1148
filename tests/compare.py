"""Compare a Spark result with DuckDB on the same Parquet tables, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both agree on column names and on every row."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)}, sql {sorted(names)}"]
    expected, actual = bag(names, cursor.fetchall()), bag(df.columns, df.collect())
    found = []
    if actual != expected:
        found.append(f"rows: spark {actual.total()}, sql {expected.total()}")
        found += [f"only spark: {r}" for r in list((actual - expected).elements())[:3]]
        found += [f"only sql: {r}" for r in list((expected - actual).elements())[:3]]
    return found
