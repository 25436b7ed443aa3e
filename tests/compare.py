"""Compare Spark results with DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(value: object) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return "NULL"
        if value is pd.NA:
            return "NULL"
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, pd.Timestamp):
            return value.strftime("%Y-%m-%d %H:%M:%S.%f")
        return repr(value)

    columns = sorted(frame.columns)
    return sorted(tuple(text(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False, name=None))
