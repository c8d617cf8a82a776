"""Alignment of a source slice with the landing schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import utc_now
from tripmill.schemas import TRIP_COLUMNS, TargetColumn


@dataclass(frozen=True)
class Lineage:
    """Provenance written into every landed row.

    ``source_file`` is the slice path; a column such as
    ``F.col("_metadata.file_path")`` records each row's own file instead.
    """

    batch_id: str
    source_file: str | Column
    migration_batch_id: str
    engine_type: str
    ingestion_ts: datetime | None = None

    def columns(self) -> list[Column]:
        arrived = (
            utc_now() if self.ingestion_ts is None else F.lit(str(self.ingestion_ts))
        )
        source = self.source_file
        if not isinstance(source, Column):
            source = F.lit(source)
        return [
            arrived.cast("timestamp_ntz").alias("ingestion_ts"),
            F.lit(self.batch_id).alias("batch_id"),
            source.cast("string").alias("source_file"),
            F.lit(self.migration_batch_id).alias("migration_batch_id"),
            F.lit(self.engine_type).alias("engine_type"),
        ]


def align(
    df: DataFrame,
    lineage: Lineage | None = None,
    cab_type: str | None = None,
    spec: Sequence[TargetColumn] = TRIP_COLUMNS,
    lenient: bool = False,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One projection to the target columns and types.

    Optional columns that the source lacks become typed NULLs; a missing
    required column is an error. ``cab_type`` overrides the column of that name.
    ``lenient`` turns text that cannot be cast into NULL instead of failing.
    ``extra`` columns of the source are added as they are.
    """
    have = set(df.columns)

    def target(column: TargetColumn) -> Column:
        if column.name == "cab_type" and cab_type is not None:
            value = F.lit(cab_type)
        elif column.name in have:
            value = F.col(column.name)
        elif column.optional:
            value = F.lit(None)
        else:
            raise ValueError(f"required column {column.name!r} is missing from the source")
        cast = value.try_cast if lenient else value.cast
        return cast(column.type).alias(column.name)

    added = lineage.columns() if lineage else []
    return df.select(*[target(c) for c in spec], *added, *extra)


def count_cast_failures(df: DataFrame, spec: Sequence[TargetColumn] = TRIP_COLUMNS) -> DataFrame:
    """One row: per column, how many values a lenient alignment would lose."""
    have = set(df.columns)
    return df.agg(
        *[
            F.count_if(
                F.col(c.name).isNotNull() & F.col(c.name).try_cast(c.type).isNull()
            ).alias(c.name)
            for c in spec
            if c.name in have
        ]
    )
