"""Scans: partitioned slices, tables, seeds, calendars and event streams."""

from tripmill.sources.calendar import date_spine, date_spine_over
from tripmill.sources.events import TRIP_EVENT, read_events_stream
from tripmill.sources.files import path_exists
from tripmill.sources.slices import (
    landed_days,
    read_aligned,
    read_slice,
    read_slices,
    slice_filter,
    slice_folders,
    slice_path,
    slice_volume,
)
from tripmill.sources.tables import read_seed, read_table

__all__ = [
    "TRIP_EVENT",
    "date_spine",
    "date_spine_over",
    "landed_days",
    "path_exists",
    "read_aligned",
    "read_events_stream",
    "read_seed",
    "read_slice",
    "read_slices",
    "read_table",
    "slice_filter",
    "slice_folders",
    "slice_path",
    "slice_volume",
]
