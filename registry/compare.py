"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB in memory with one view per given table, in UTC."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def _bag(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_key(row[i]) for i in order) for row in rows
    )


# How DuckDB calls the Spark types that results use.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree on columns, types and the exact bag of rows."""
    df = query(spark, sf_dir)
    kinds = {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}
    expected = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    if kinds != expected:
        return f"types {kinds} != {expected}"
    ours = _bag(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = _bag([d[0] for d in cursor.description], cursor.fetchall())
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
