"""Compare a Spark result with its SQL in DuckDB, row by row, without tolerance."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(expected_columns)}"
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    expected = _bag(expected_columns, cursor.fetchall())
    if got == expected:
        return None
    only_spark, only_sql = list((got - expected).items()), list((expected - got).items())
    return (
        f"{sum(got.values())} / {sum(expected.values())} rows, {len(only_spark)} only in Spark, "
        f"{len(only_sql)} only in SQL; columns {sorted(df.columns)}; e.g. {only_spark[:2]} / {only_sql[:2]}"
    )
