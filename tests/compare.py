"""Exact comparison of a Spark result with the SQL engine's result for the same tables."""

from __future__ import annotations

from collections import Counter

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


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values must be equal to the last digit."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    order = [names.index(c) for c in df.columns]
    expected = Counter(tuple(row[i] for i in order) for row in found.fetchall())
    actual = Counter(tuple(row) for row in df.collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(missing.values())} rows missing, e.g. {next(iter(missing), None)}; "
        f"{sum(extra.values())} rows extra, e.g. {next(iter(extra), None)}; "
        f"{sum(expected.values())} expected in all"
    )
