"""Derived trip measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone ids of the three airports.
AIRPORT_ZONES = (1, 132, 138)

# First hour, last hour and name of each part of the day.
DAY_PARTS = (
    (6, 9, "morning"),
    (10, 15, "afternoon"),
    (16, 19, "evening"),
    (20, 23, "night"),
)
REST_OF_DAY = "late_night"


def time_of_day(ts: Column) -> Column:
    (first, last, name), *others = DAY_PARTS
    part = F.when(F.hour(ts).between(first, last), name)
    for first, last, name in others:
        part = part.when(F.hour(ts).between(first, last), name)
    return part.otherwise(REST_OF_DAY)


def is_airport_trip(pickup_zone: Column, dropoff_zone: Column) -> Column:
    """True if either end is an airport; an unknown zone counts as no airport."""
    either = pickup_zone.isin(*AIRPORT_ZONES) | dropoff_zone.isin(*AIRPORT_ZONES)
    return F.coalesce(either, F.lit(False))


def tip_pct(tip: Column, fare: Column) -> Column:
    """Tip as percentage of the fare; NULL for a zero fare."""
    return F.round(tip / F.nullif(fare, F.lit(0.0)) * 100, 2)
