"""Column expressions shared by the operators."""

from tripmill.functions.keys import slice_id, snapshot_id, surrogate_key
from tripmill.functions.times import half_open, minute_boundaries, truncate, utc_now
from tripmill.functions.trips import is_airport_trip, time_of_day, tip_pct

__all__ = [
    "half_open",
    "is_airport_trip",
    "minute_boundaries",
    "slice_id",
    "snapshot_id",
    "surrogate_key",
    "time_of_day",
    "tip_pct",
    "truncate",
    "utc_now",
]
