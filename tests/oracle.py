"""Runs a registered query and its SQL on the same files and compares the results exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[str], list[tuple]]:
    with duckdb.connect() as db:
        for file in Path(folder).glob("*.parquet"):
            db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        result = db.sql(sql)
        return result.columns, [str(t) for t in result.types], result.fetchall()


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def compare(df: DataFrame, sql: str, folder: str) -> int:
    """Assert equal names, types and rows; returns the number of rows."""
    columns, types, expected = oracle_rows(sql, folder)
    assert sorted(df.columns) == sorted(columns)
    found_types = {name: SAME_TYPE[kind] for name, kind in df.dtypes}
    assert found_types == dict(zip(columns, types))
    found = [tuple(row) for row in df.collect()]
    assert len(found) == len(expected)
    assert canonical(df.columns, found) == canonical(columns, expected)
    return len(found)
