"""Structured Streaming: staging, upsert, windows, deduplication, late rows."""

from tripmill.streaming.trips import (
    first_of_each,
    fold_deltas,
    fold_new,
    read_counts,
    split_late,
    stream_counts,
    stream_dedup,
    stream_deltas,
    stream_insert_new,
    stream_split,
    stream_stage,
    stream_to_table,
    stream_upsert,
    trips_per_minute,
)

__all__ = [
    "first_of_each",
    "fold_deltas",
    "fold_new",
    "read_counts",
    "split_late",
    "stream_counts",
    "stream_dedup",
    "stream_deltas",
    "stream_insert_new",
    "stream_split",
    "stream_stage",
    "stream_to_table",
    "stream_upsert",
    "trips_per_minute",
]
