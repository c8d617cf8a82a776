"""Profiles, top values and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.schemas import LINEAGE_COLUMNS


def null_profile(
    df: DataFrame, columns: Sequence[str] = tuple(c.name for c in LINEAGE_COLUMNS)
) -> DataFrame:
    """One row with the number of NULLs of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def load_profile(df: DataFrame) -> DataFrame:
    """Rows, pickup span and last arrival of each cab type."""
    return (
        df.groupBy("cab_type")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("pickup_datetime").alias("earliest_trip"),
            F.max("pickup_datetime").alias("latest_trip"),
            F.max("ingestion_ts").alias("last_ingested"),
        )
        .orderBy("cab_type")
    )


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The most frequent values; equal counts in order of the value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.col("row_count").desc(), F.col(column).asc_nulls_last()).limit(n)


def top_rows(df: DataFrame, by: str, n: int, columns: Sequence[str]) -> DataFrame:
    """The rows with the largest values; ties by the other columns, ascending."""
    ties = [F.col(c).asc_nulls_last() for c in columns if c != by]
    return df.select(*columns).orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def sample_rows(df: DataFrame, n: int = 1, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at; with ``order_by`` always the same ones."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
