"""Streaming source of JSON trip events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.schemas import LAKE_TRIPS

# A trip event carries the columns of a lake row.
TRIP_EVENT = LAKE_TRIPS


def read_events_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str = TRIP_EVENT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files of JSON lines as a stream; a stream never infers its schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(directory)
