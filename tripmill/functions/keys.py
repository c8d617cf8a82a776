"""Text keys: surrogate keys, snapshot ids and slice ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL key part contributes to the hashed text.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# The columns that identify a trip.
TRIP_KEY = (
    "vendor_id",
    "cab_type",
    "pickup_datetime",
    "pickup_location_id",
    "dropoff_location_id",
)

# The same columns with the most distinct values first: sorting by them compares
# mostly the first.
TRIP_KEY_SELECTIVE_FIRST = (
    "pickup_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "vendor_id",
    "cab_type",
)


def surrogate_key(*parts: str) -> Column:
    """md5 over the ``-``-joined text of the parts.

    ``concat_ws`` skips NULLs, which would let different keys collide, so every
    part is made non-NULL first. Casting ``timestamp_ntz`` to text does not
    depend on the session time zone.
    """
    texts = [F.coalesce(F.col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def snapshot_id(key: Column, updated_at: Column) -> Column:
    """Row id of one version in a history table."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat_ws("|", *parts))


def slice_id(cab_type: Column, day: Column) -> Column:
    """Ledger key of one day of one cab type, such as ``green#2024_01_31``."""
    return F.concat_ws("#", F.lower(cab_type), F.date_format(day, "yyyy_MM_dd"))
