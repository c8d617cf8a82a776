"""Declared schemas.

Trip times are local wall-clock values without a zone, so they are
``timestamp_ntz``: no session zone or daylight-saving change can move them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TargetColumn:
    """One column of a landing target: its type, and whether a source may lack it."""

    name: str
    type: str
    optional: bool = False


# The trip columns of the lake table, in write order.
TRIP_COLUMNS: tuple[TargetColumn, ...] = (
    TargetColumn("vendorid", "int"),
    TargetColumn("cab_type", "string"),
    TargetColumn("pickup_datetime", "timestamp_ntz"),
    TargetColumn("dropoff_datetime", "timestamp_ntz"),
    TargetColumn("store_and_fwd_flag", "string"),
    TargetColumn("ratecodeid", "bigint"),
    TargetColumn("pulocationid", "int"),
    TargetColumn("dolocationid", "int"),
    TargetColumn("passenger_count", "bigint"),
    TargetColumn("trip_distance", "double"),
    TargetColumn("fare_amount", "double"),
    TargetColumn("extra", "double"),
    TargetColumn("mta_tax", "double"),
    TargetColumn("tip_amount", "double"),
    TargetColumn("tolls_amount", "double"),
    TargetColumn("ehail_fee", "double", optional=True),
    TargetColumn("improvement_surcharge", "double"),
    TargetColumn("total_amount", "double"),
    TargetColumn("payment_type", "bigint"),
    TargetColumn("trip_type", "bigint", optional=True),
    TargetColumn("congestion_surcharge", "double", optional=True),
    TargetColumn("airport_fee", "double", optional=True),
)

# The lineage columns that landing adds.
LINEAGE_COLUMNS: tuple[TargetColumn, ...] = (
    TargetColumn("ingestion_ts", "timestamp_ntz"),
    TargetColumn("batch_id", "string"),
    TargetColumn("source_file", "string"),
    TargetColumn("migration_batch_id", "string"),
    TargetColumn("engine_type", "string"),
)

# The cab types the platform knows.
CAB_TYPES: tuple[str, ...] = ("yellow", "green", "fhv", "high_volume_fhv")


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(**columns: str) -> T.StructType:
    """Schema from names and type names; needs no running session, unlike DDL text."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in columns.items()])


def struct_of(columns: tuple[TargetColumn, ...]) -> T.StructType:
    return struct(**{c.name: c.type for c in columns})


LAKE_TRIPS = struct_of(TRIP_COLUMNS + LINEAGE_COLUMNS)

# A source slice has no cab type or lineage in its files; cab_type, year, month
# and day are directory names.
TRIP_SLICE = struct_of(tuple(c for c in TRIP_COLUMNS if c.name != "cab_type"))
SLICE_PARTITIONS = struct(cab_type="string", year="int", month="int", day="int")

ZONES = struct(locationid="int", borough="string", zone="string", service_zone="string")
VENDORS = struct(vendor_id="int", vendor_name="string", status="string")

LEDGER = struct(
    slice_id="string",
    batch_id="string",
    status="string",
    engine="string",
    landed_at="timestamp_ntz",
)
SLICE_REQUESTS = struct(cab_type="string", year="string", month="string", day="string")
