"""Source-against-target validation of a landed table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.compare import compare_metrics
from tripmill.operators.profile import load_profile, null_profile, top_rows, top_values
from tripmill.operators.slicing import slice_day, slice_year

# What the largest trips are compared by.
TOP_TRIP_COLUMNS = ("vendorid", "pulocationid", "total_amount", "pickup_datetime")


def _by_month(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("cab_type", F.month(column).alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("total_amount").alias("total_amount"),
        F.min(column).alias("first_pickup"),
        F.max(column).alias("last_pickup"),
    )


def report(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each comparison: how many groups it has, and how many differ."""
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("groups"), F.count_if(~F.col("matches")).alias("mismatches")
        ).select(F.lit(name).alias("comparison"), "groups", "mismatches")
        for name, df in results.items()
        if "matches" in df.columns
    ]
    return reduce(DataFrame.unionByName, rows)


def validate(
    source: DataFrame,
    target: DataFrame,
    year: int,
    sample_day: date,
    cab_types: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The comparisons of one year, by name; every one is a small table.

    Counts, sums and ranges roll up one aggregate by cab type and month of each side;
    asked for together (:func:`report`), each side is scanned for it once.
    """
    column = "pickup_datetime"
    s = slice_year(source, column, year, cab_types=cab_types)
    t = slice_year(target, column, year, cab_types=cab_types)
    by_month = [_by_month(side, column) for side in (s, t)]
    # no row at all is a count of 0, as in a count over rows
    count = {"row_count": "coalesce(sum(row_count), 0)"}
    total = {"total_amount": "sum(total_amount)"}
    span = {"first_pickup": "min(first_pickup)", "last_pickup": "max(last_pickup)"}
    tops = [top_values(side, "pulocationid", 20) for side in (s, t)]
    trips = [top_rows(side, "total_amount", 10, TOP_TRIP_COLUMNS) for side in (s, t)]
    return {
        "count": compare_metrics(*by_month, metrics=count),
        "count_by_cab": compare_metrics(*by_month, {"cab_type": "cab_type"}, count),
        "count_by_month": compare_metrics(*by_month, {"month": "month"}, count),
        "sum": compare_metrics(*by_month, metrics=total),
        "sum_by_cab": compare_metrics(*by_month, {"cab_type": "cab_type"}, total),
        "range": compare_metrics(*by_month, metrics=span),
        "day": compare_metrics(
            slice_day(source, column, sample_day), slice_day(target, column, sample_day)
        ),
        "source_top_zones": tops[0],
        "target_top_zones": tops[1],
        "top_zones": compare_metrics(
            *tops, {"pulocationid": "pulocationid"}, {"row_count": "max(row_count)"}
        ),
        "source_top_trips": trips[0],
        "target_top_trips": trips[1],
        "top_trips": compare_metrics(*trips, {c: c for c in TOP_TRIP_COLUMNS}),
        "lineage_nulls": null_profile(t),
        "load_profile": load_profile(t),
    }
