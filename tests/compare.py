"""Order-insensitive comparison of a Spark result with its SQL statement in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(df, connection, statement) -> list[str]:
    """What differs in names, types, row count or values; empty when all agree."""
    found = []
    result = connection.execute(statement)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            found.append(f"{name}: {kind} against {kinds[name]}")
    actual = df.collect()
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows against {len(expected)}")
    left, right = _rows(df.columns, actual), _rows(names, expected)
    if left != right:
        pair = next(((a, b) for a, b in zip(left, right) if a != b), None)
        found.append(f"values differ, first: {pair}")
    return found
