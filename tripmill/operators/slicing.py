"""Time slices and arrival increments."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import half_open

# Earlier than any arrival, so an empty target takes everything.
BEFORE_ALL_DATA = "0001-01-01 00:00:00"


def slice_by_time(
    df: DataFrame,
    column: str,
    start: date | datetime,
    end: date | datetime,
    cab_types: Sequence[str] | None = None,
    partition_column: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows with ``start <= column < end``, optionally of some cab types only.

    The range form is pushed into Parquet, unlike ``year(column) = ...``. Name
    the day partition column to prune folders as well. ``inclusive`` keeps rows
    at exactly ``end`` too.
    """
    kept = half_open(column, start, end)
    if inclusive:
        kept = kept | (F.col(column) == F.lit(str(end)).cast("timestamp_ntz"))
    if partition_column is not None:
        days = F.col(partition_column)
        kept = kept & (days >= F.lit(str(start)[:10]).cast("date"))
        kept = kept & (days <= F.lit(str(end)[:10]).cast("date"))
    if cab_types is not None:
        kept = kept & F.col("cab_type").isin(*cab_types)
    return df.where(kept)


def slice_year(df: DataFrame, column: str, year: int, **options) -> DataFrame:
    return slice_by_time(df, column, date(year, 1, 1), date(year + 1, 1, 1), **options)


def slice_day(df: DataFrame, column: str, day: date, **options) -> DataFrame:
    return slice_by_time(df, column, day, day + timedelta(days=1), **options)


def new_since(
    df: DataFrame,
    target: DataFrame | None,
    column: str = "ingestion_ts",
    inclusive: bool = False,
) -> DataFrame:
    """Rows that arrived after everything in the target; all rows if it is empty.

    The high-water mark is a scalar subquery, which Spark runs first and pushes
    into the Parquet scan. ``inclusive`` takes rows at the mark again, so that no
    batch with the same timestamp is missed; an upsert that keeps the latest
    submission then gives the same table again. Rows without an arrival time are
    always taken, since nothing tells that they are known; the upsert makes that harmless.
    """
    if target is None:
        return df
    start = F.lit(BEFORE_ALL_DATA).cast("timestamp_ntz")
    mark = target.agg(F.coalesce(F.max(column), start)).scalar()
    return arrived_after(df, mark, column, inclusive)


def arrived_after(
    df: DataFrame, mark: Column, column: str = "ingestion_ts", inclusive: bool = False
) -> DataFrame:
    """Rows that arrived after a mark (``inclusive``: or at it), and those without an arrival time."""
    newer = F.col(column) >= mark if inclusive else F.col(column) > mark
    return df.where(newer | F.col(column).isNull())
