"""Compare a Spark result with the result of the SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    """One form for values that differ only by their Python type."""
    if isinstance(value, (decimal.Decimal, float)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, bool):
        return str(value)
    return str(value)


def multiset(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if r[i] is None else plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = multiset(columns, cursor.fetchall())
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"got {g} want {w} for {sorted(columns)}"
    return None
