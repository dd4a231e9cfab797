"""Run a query and its SQL twin on the same tables and compare all rows."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def table(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree in columns and rows."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: {sorted(spark_df.columns)} != {sorted(names)}"]
    expected = table(names, rel.fetchall())
    actual = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if len(expected) != len(actual):
        found.append(f"rows: {len(actual)} != {len(expected)}")
    left, right = set(actual), set(expected)
    found += [f"only spark: {r}" for r in sorted(left - right)[:3]]
    found += [f"only sql:   {r}" for r in sorted(right - left)[:3]]
    if not found and actual != expected:
        found.append("same distinct rows, other multiplicity")
    wide = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, spark_type in spark_df.dtypes:
        if wide.get(spark_type, kinds[name]) != kinds[name]:
            found.append(f"type of {name}: {spark_type} / {kinds[name]}")
    return found
