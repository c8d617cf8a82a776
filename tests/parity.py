"""Strict comparison of a Spark result with DuckDB's result for the oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both results hold the same columns and the same rows."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    actual = spark_result.collect()
    if sorted(names) != sorted(spark_result.columns):
        return f"columns {sorted(spark_result.columns)} != {sorted(names)}"
    ours, theirs = _bag(actual, spark_result.columns), _bag(expected, names)
    if ours == theirs:
        return ""
    missing, extra = theirs - ours, ours - theirs
    return (
        f"{len(actual)} rows against {len(expected)}; missing {sum(missing.values())},"
        f" extra {sum(extra.values())}\n  missing: {next(iter(missing), None)}"
        f"\n  extra:   {next(iter(extra), None)}"
    )
