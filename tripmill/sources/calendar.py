"""Calendar rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar holds 3,650 days.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2029, 12, 28)


def date_spine(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def date_spine_over(df: DataFrame, column: str) -> DataFrame:
    """The days between the first and the last value of a column."""
    bounds = df.agg(
        F.min(column).cast("date").alias("first_day"),
        F.max(column).cast("date").alias("last_day"),
    )
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day")).alias("date_key")
    )
