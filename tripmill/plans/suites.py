"""The assertions of every model, as data."""

from __future__ import annotations

from datetime import timedelta

from tripmill.operators.checks import Check, between, freshness, in_set, not_null, relationship, unique
from tripmill.schemas import CAB_TYPES

VENDOR_STATUSES = ("active", "suspended", "inactive")

STAGED_TRIPS: list[Check] = not_null(
    "vendor_id",
    "cab_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "total_amount",
    "ingestion_ts",
)

CORE_TRIPS: list[Check] = [
    unique("trip_id"),
    *not_null(
        "trip_id",
        "cab_type",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "trip_distance",
        "fare_amount",
        "total_amount",
        "passenger_count",
        "trip_duration_minutes",
        "ingestion_ts",
    ),
    in_set("cab_type", CAB_TYPES),
    between("trip_distance", minimum=0, strict=True),
    between("fare_amount", minimum=0),
    between("total_amount", minimum=0, strict=True),
    between("passenger_count", minimum=1, maximum=6),
]

DIM_ZONE: list[Check] = [*not_null("location_id"), unique("location_id")]
DIM_DATE: list[Check] = [*not_null("date_key"), unique("date_key")]

FACT_TRIPS: list[Check] = [
    *not_null("trip_id"),
    unique("trip_id"),
    *not_null("cab_type"),
    in_set("cab_type", CAB_TYPES),
    *not_null(
        "pickup_datetime",
        "dropoff_datetime",
        "total_amount",
        "trip_duration_minutes",
        "ingestion_ts",
    ),
    relationship("pickup_location_id", "dim_taxi_zone", "location_id"),
    relationship("dropoff_location_id", "dim_taxi_zone", "location_id"),
]

VENDOR_HISTORY: list[Check] = [
    *not_null("vendor_id", "vendor_name", "status", "dbt_scd_id"),
    unique("dbt_scd_id"),
    *not_null("dbt_valid_from", "dbt_updated_at"),
]

VENDOR_SEED: list[Check] = [
    *not_null("vendor_id"),
    unique("vendor_id"),
    *not_null("vendor_name", "status"),
    in_set("status", VENDOR_STATUSES),
]

SUITES: dict[str, list[Check]] = {
    "stg_trip_data": STAGED_TRIPS,
    "int_trip_data_core": CORE_TRIPS,
    "dim_taxi_zone": DIM_ZONE,
    "dim_date": DIM_DATE,
    "fact_trip": FACT_TRIPS,
    "snap_vendor": VENDOR_HISTORY,
    "vendor": VENDOR_SEED,
}

# The models' assertions and the freshness of their source, in one suite.
WITH_FRESHNESS: dict[str, list[Check]] = {
    **SUITES,
    "stg_trip_data": [*STAGED_TRIPS, freshness("ingestion_ts", timedelta(hours=48))],
}
