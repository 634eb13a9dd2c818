"""Run a query in Spark and its SQL in DuckDB and compare whole results."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _value(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple((type(_value(row[i])).__name__, _value(row[i])) for i in order) for row in rows)


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    found = _rows(df.columns, [tuple(row) for row in df.collect()])
    if found == expected:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"{sum(found.values())} rows instead of {sum(expected.values())}; "
        f"missing {sum(missing.values())}, e.g. {list(missing)[:2]}; "
        f"extra {sum(extra.values())}, e.g. {list(extra)[:2]}"
    )
