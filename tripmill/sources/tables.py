"""Scans of tables and seed files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet table; the declared schema also fixes the partition column types."""
    return spark.read.schema(schema).parquet(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Small reference data kept as CSV with a header line."""
    return spark.read.schema(schema).option("header", True).csv(path)
