"""Zone lookup, trip keys and the core and fact projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import (
    is_airport_trip,
    minute_boundaries,
    surrogate_key,
    time_of_day,
    tip_pct,
)
from tripmill.functions.keys import TRIP_KEY, TRIP_KEY_SELECTIVE_FIRST
from tripmill.operators.dedup import keep_latest, latest_first
from tripmill.operators.quality import quality_filter

# A lookup within both bounds is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


class DuplicateLookupKey(ValueError):
    """A lookup has several rows for one key, so joining it would add rows."""


def checked_lookup(lookup: DataFrame, key: str) -> DataFrame:
    """Measure a lookup table before it is joined.

    Fails if the key is not unique. Marks the table for broadcast only if its
    measured size is within the bounds; otherwise Spark joins it by shuffle,
    where AQE splits a hot key. The measuring stops at the row bound.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in lookup.columns),
        F.lit(0),
    )
    measured = lookup.limit(BROADCAST_ROWS + 1).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(key).alias("keys"),
        F.count_distinct(key).alias("distinct_keys"),
        F.sum(width).alias("bytes"),
    ).first()
    if measured["keys"] != measured["distinct_keys"]:
        raise DuplicateLookupKey(f"lookup key {key!r} is not unique")
    if measured["rows"] <= BROADCAST_ROWS and (measured["bytes"] or 0) <= BROADCAST_BYTES:
        return F.broadcast(lookup)
    repeated = lookup.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")
    if repeated.take(1):
        raise DuplicateLookupKey(f"lookup key {key!r} is not unique")
    return lookup


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone and borough names of both trip ends; unknown zones give NULL.

    ``zones`` must be unique by ``location_id``; pass it through
    :func:`checked_lookup` first.
    """
    for role in ("pickup", "dropoff"):
        named = zones.select(
            F.col("location_id").alias(f"{role}_location_id"),
            F.col("zone").alias(f"{role}_zone"),
            F.col("borough").alias(f"{role}_borough"),
        )
        trips = trips.join(named, f"{role}_location_id", "left")
    return trips


# The columns of the core table, in order.
CORE_COLUMNS = (
    "trip_id",
    "vendor_id",
    "cab_type",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_minutes",
    "store_and_fwd_flag",
    "rate_code_id",
    "pickup_location_id",
    "pickup_zone",
    "pickup_borough",
    "dropoff_location_id",
    "dropoff_zone",
    "dropoff_borough",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "ehail_fee",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "payment_type",
    "trip_type",
    "ingestion_ts",
    "batch_id",
    "source_file",
    "migration_batch_id",
    "engine_type",
)

# What decides between submissions of one trip.
LATEST_FIRST = ("dropoff_datetime", "ingestion_ts")


def core_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Clean, keyed trips, one per key, with zone names and duration.

    Rows are deduplicated by the key columns themselves, so a filter on pickup
    time or cab type reaches the scan through this step. The hashed key and the
    zone names depend on those columns only and are added afterwards: the
    shuffle carries narrower rows and no row is hashed in vain.
    """
    clean = quality_filter(staged)
    key = TRIP_KEY_SELECTIVE_FIRST
    return _keyed(keep_latest(clean, key, latest_first(clean, key, LATEST_FIRST)), zones)


def core_submissions(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Every clean submission in the columns of ``core_trips``, without a shuffle.

    For a keyed table: the upsert ranks submissions by ``core_order``, as ``core_trips`` does.
    """
    return _keyed(quality_filter(staged), zones)


def _keyed(clean: DataFrame, zones: DataFrame) -> DataFrame:
    duration = minute_boundaries(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (
        enrich_zones(clean, zones)
        .withColumns({"trip_id": surrogate_key(*TRIP_KEY), "trip_duration_minutes": duration})
        .select(*CORE_COLUMNS)
    )


def core_order(columns: list[str]) -> list[str]:
    """Complete ordering by which two core rows of one key are compared."""
    lookups = {"pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough"}
    settled = {"trip_id", "trip_duration_minutes", *TRIP_KEY, *LATEST_FIRST} | lookups
    return [*LATEST_FIRST, *[c for c in columns if c not in settled]]


# The columns of the fact table, in order.
FACT_COLUMNS = (
    "trip_id",
    "vendor_id",
    "cab_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date_key",
    "dropoff_date_key",
    "trip_duration_minutes",
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_zone",
    "pickup_borough",
    "dropoff_zone",
    "dropoff_borough",
    "store_and_fwd_flag",
    "rate_code_id",
    "passenger_count",
    "trip_distance",
    "payment_type",
    "trip_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "ehail_fee",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
    "tip_pct",
    "time_of_day",
    "is_airport_trip",
    "ingestion_ts",
)


def fact_trips(core: DataFrame) -> DataFrame:
    """Fact rows: date keys and derived measures, without batch lineage."""
    derived = {
        "pickup_date_key": F.to_date("pickup_datetime"),
        "dropoff_date_key": F.to_date("dropoff_datetime"),
        "tip_pct": tip_pct(F.col("tip_amount"), F.col("fare_amount")),
        "time_of_day": time_of_day(F.col("pickup_datetime")),
        "is_airport_trip": is_airport_trip(
            F.col("pickup_location_id"), F.col("dropoff_location_id")
        ),
    }
    return core.withColumns(derived).select(*FACT_COLUMNS)
