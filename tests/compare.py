"""Run a query in Spark and its SQL form in DuckDB and compare all values."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(root, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else a short description."""
    got_types = {name: SQL_TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    want_types = {row[0]: str(row[1]) for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    got_columns, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_columns, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for g, w in zip(got, want):
        if g != w:
            return f"spark {str(g)[:400]}\n   sql {str(w)[:400]}"
    return None
