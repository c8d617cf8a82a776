"""Staging: rename, cast and clean text, one projection per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _clean(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


# Staged name, source name and type, in output order. "text" is
# trimmed and lower-cased.
TRIP_STAGING = (
    ("vendor_id", "vendorid", "int"),
    ("cab_type", "cab_type", "text"),
    ("pickup_datetime", "pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "text"),
    ("rate_code_id", "ratecodeid", "int"),
    ("pickup_location_id", "pulocationid", "int"),
    ("dropoff_location_id", "dolocationid", "int"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("ehail_fee", "ehail_fee", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "airport_fee", "double"),
    ("payment_type", "payment_type", "int"),
    ("trip_type", "trip_type", "int"),
    ("ingestion_ts", "ingestion_ts", "timestamp_ntz"),
    ("batch_id", "batch_id", "string"),
    ("source_file", "source_file", "string"),
    ("migration_batch_id", "migration_batch_id", "string"),
    ("engine_type", "engine_type", "string"),
)


def stage_trips(df: DataFrame) -> DataFrame:
    """Lake trips with snake-case names. Works on batch and streaming frames."""
    return df.select(
        *[
            (_clean(source) if kind == "text" else F.col(source).cast(kind)).alias(name)
            for name, source, kind in TRIP_STAGING
        ]
    )


def stage_zones(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("locationid").cast("int").alias("location_id"),
        *[_clean(c).alias(c) for c in ("borough", "zone", "service_zone")],
    )


def stage_vendors(df: DataFrame) -> DataFrame:
    """Vendor names keep their case."""
    return df.select(
        F.col("vendor_id").cast("int").alias("vendor_id"),
        F.trim("vendor_name").alias("vendor_name"),
        _clean("status").alias("status"),
    )
