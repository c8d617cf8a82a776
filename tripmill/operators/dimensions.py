"""Date and zone dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes; weeks are ISO weeks, day 0 is Sunday."""
    day = F.col("date_key")
    return spine.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "yyyy-MM-dd").alias("date_str"),
        F.date_format(day, "E").alias("day_name"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
    ).orderBy("date_key")


def dim_zone(staged_zones: DataFrame) -> DataFrame:
    return staged_zones.select("location_id", "borough", "zone", "service_zone")
