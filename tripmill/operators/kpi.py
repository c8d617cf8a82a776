"""Trip key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import truncate


def trip_kpis(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trips, revenue, average duration and passengers, overall or per group."""
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("fare_amount").alias("total_fare_revenue"),
        F.sum("total_amount").alias("total_amount"),
        F.avg("trip_duration_minutes").alias("avg_trip_minutes"),
        F.sum("passenger_count").alias("passengers_carried"),
    )


def daily_partials(fact: DataFrame, by: Sequence[str] = ("cab_type",)) -> DataFrame:
    """Figures of a pickup day that add up over days and groups; ``fact`` may be any part made of whole days."""
    minutes = F.col("trip_duration_minutes")
    return fact.groupBy(*dict.fromkeys([*by, "pickup_date_key"])).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("fare_amount").alias("total_fare_revenue"),
        F.sum("total_amount").alias("total_amount"),
        F.sum(minutes).alias("trip_minutes"),
        F.count(minutes).alias("timed_trips"),
        F.sum("passenger_count").alias("passengers_carried"),
    )


def kpis_of_partials(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The figures of ``trip_kpis`` from daily partials instead of trips."""
    return partials.groupBy(*by).agg(
        F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"),
        F.sum("total_fare_revenue").alias("total_fare_revenue"),
        F.sum("total_amount").alias("total_amount"),
        (F.sum("trip_minutes") / F.nullif(F.sum("timed_trips"), F.lit(0))).alias("avg_trip_minutes"),
        F.sum("passengers_carried").alias("passengers_carried"),
    )


def cumulative_of_partials(partials: DataFrame) -> DataFrame:
    """The running totals of ``cumulative_trips`` by day from daily partials."""
    days = partials.groupBy("cab_type", F.col("pickup_date_key").cast("timestamp_ntz").alias("bucket")).agg(
        F.sum("trip_count").alias("trips")
    )
    return _running(days)


# Parts of a pickup time that periods are compared by; each has few values.
BUCKETS = {"hour_of_day": F.hour, "day_of_week": F.dayofweek, "month_of_year": F.month}

FIGURES = ("trip_count", "total_fare_revenue", "avg_trip_minutes", "passengers_carried")


def kpi_vs_baseline(
    current: DataFrame,
    baseline: DataFrame,
    bucket: str = "hour_of_day",
    figures: Sequence[str] = FIGURES,
) -> DataFrame:
    """Key figures per part of the day, week or year against those of an earlier period.

    Both periods shrink to at most 24 rows before they meet. A figure that one
    period lacks counts as 0 in the difference; averages differ only where both exist.
    """
    if bucket not in BUCKETS:
        raise ValueError(f"unknown bucket {bucket!r}")

    def per_bucket(df: DataFrame, name: str) -> DataFrame:
        grouped = trip_kpis(df.withColumn(bucket, BUCKETS[bucket]("pickup_datetime")), [bucket])
        return grouped.select(bucket, *[F.col(f).alias(f"{name}_{f}") for f in figures])

    both = per_bucket(current, "current").join(
        per_bucket(baseline, "baseline"), bucket, "full_outer"
    )

    def side(name: str, figure: str) -> Column:
        value = F.col(f"{name}_{figure}")
        return value if figure.startswith("avg") else F.coalesce(value, F.lit(0))

    deltas = [(side("current", f) - side("baseline", f)).alias(f"delta_{f}") for f in figures]
    change = (
        (F.col("current_trip_count") - F.col("baseline_trip_count"))
        / F.nullif(F.col("baseline_trip_count"), F.lit(0))
        * 100
    )
    return both.select("*", *deltas, change.alias("trip_count_change_pct"))


def cumulative_trips(fact: DataFrame, bucket: str = "hour") -> DataFrame:
    """Running number of trips per cab type over time buckets.

    Trips are counted per bucket first: the window then sees buckets, whose
    number is bounded by time and not by the number of trips.
    """
    counts = fact.groupBy(
        "cab_type", truncate(F.col("pickup_datetime"), bucket).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("trips"))
    return _running(counts)


def _running(counts: DataFrame) -> DataFrame:
    so_far = (
        Window.partitionBy("cab_type")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counts.withColumn("cumulative_trips", F.sum("trips").over(so_far))
