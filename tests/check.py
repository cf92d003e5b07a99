"""Compare queries with their SQL: row count, column names, types and values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NA:
        return None
    return value.item() if hasattr(value, "item") else value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df, connection, sql: str) -> list[str]:
    """Empty if the query result equals the SQL result."""
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    found = []
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if types != described:
        found.append(f"types {types} != {described}")
    mine, theirs = _rows(df.toPandas()), _rows(connection.execute(sql).fetchdf())
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
