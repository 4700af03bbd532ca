"""Compares a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

SF_DIR = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def as_multiset(rows, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, sql: str, sf_dir: str) -> list[str]:
    """What differs between a Spark result and the SQL's; empty when they agree."""
    result = duck(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    expected, actual = as_multiset(result.fetchall(), names), as_multiset(df.collect(), df.columns)
    if expected == actual:
        return []
    only_sql, only_spark = expected - actual, actual - expected
    return [
        f"{sum(actual.values())} rows, SQL {sum(expected.values())}",
        f"only in Spark: {list(only_spark.items())[:3]}",
        f"only in SQL: {list(only_sql.items())[:3]}",
    ]
