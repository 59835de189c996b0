"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _comparable(value):
    if isinstance(value, float):
        if math.isnan(value) or math.isinf(value):
            return repr(value)
        return f"{value + 0.0:.6f}"
    return repr(value)


def _table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_comparable(row[i]) for i in order) for row in rows])


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result, rows in any order."""
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    expected_rows = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(columns)}"]
    actual = _table([tuple(row) for row in frame.collect()], frame.columns)
    expected = _table(expected_rows, columns)
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)}"]
    return [f"{a} != {e}" for a, e in zip(actual, expected) if a != e][:5]
