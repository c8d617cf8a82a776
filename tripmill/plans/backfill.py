"""Backfill of a source slice into the lake table, once per day of data."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.align import Lineage
from tripmill.operators.ledger import (
    FAILED,
    HIGH_VOLUME_BYTES,
    LANDED,
    append_ledger,
    expand_slices,
    ledger_rows,
    pending_slices,
    read_ledger,
    volume_class,
)
from tripmill.plans.trip_build import BY_DAY
from tripmill.schemas import CAB_TYPES, SLICE_REQUESTS
from tripmill.sinks import land, plan_write
from tripmill.sources import read_aligned, slice_folders, slice_path, slice_volume

ALL = "ALL"
REJECT_PARTITIONS = ["cab_type", "folder_day"]


@dataclass(frozen=True)
class BackfillReport:
    """What a backfill did: ``landed``, ``nothing_pending`` or ``empty``."""

    outcome: str
    batch_id: str
    days: int = 0
    rows: int = 0
    rejected: int = 0
    source_bytes: int = 0
    volume_class: str = "empty"


def new_batch_id(
    engine: str, cab_type: str, year: str, month: str | None, day: str | None
) -> str:
    """Such as ``spark#green#2024_01_ALL#1a2b3c4d``."""
    parts = [str(year), *[ALL if p is None else str(p).zfill(2) for p in (month, day)]]
    return f"{engine}#{cab_type}#{'_'.join(parts)}#{uuid.uuid4().hex[:8]}"


def split_own_day(df: DataFrame, day_column: str = "folder_day") -> tuple[DataFrame, DataFrame]:
    """Rows picked up on the day of their own source folder, and all others.

    Landing replaces whole days. A row of another day than its folder's would come
    and go with whatever else is pending, so it belongs to no landed day, nor does
    a row without pickup time. Both sides together are the input.
    """
    own = _on_own_day(day_column)
    return df.where(own).drop(day_column), df.where(~own).drop(day_column)


def _on_own_day(day_column: str = "folder_day") -> Column:
    start = F.col(day_column).cast("timestamp_ntz")
    pickup = F.col("pickup_datetime")
    return F.coalesce(
        (pickup >= start) & (pickup < start + F.expr("INTERVAL 1 DAY")), F.lit(False)
    )


def _folder_day() -> Column:
    return F.make_date("year", "month", "day")


def backfill(
    spark: SparkSession,
    source: str,
    table: str,
    ledger: str,
    rejects: str,
    cab_type: str,
    year: str,
    month: str | None = None,
    day: str | None = None,
    engine: str = "spark",
    engine_type: str = "SPARK_BATCH",
    batch_id: str | None = None,
    now: datetime | None = None,
    threshold_bytes: int = HIGH_VOLUME_BYTES,
) -> BackfillReport:
    """Land the days of a slice that are not landed yet.

    Only pending days are read. The ledger is written after the data; a failure
    is recorded as such and raised. A day without source files stays pending, so
    that it can land later. Rows that were not picked up on their folder's day go to
    ``rejects``, by cab type and folder day, so what a day holds does not depend on what else is
    pending. Both the table's days and the rejects' are replaced as a whole: a day that is landed
    again and has no row any more, or no reject, keeps none of the old ones.
    """
    if cab_type not in CAB_TYPES:
        raise ValueError(f"unknown cab type {cab_type!r}")
    batch_id = batch_id or new_batch_id(engine, cab_type, year, month, day)
    request = spark.createDataFrame([(cab_type, year, month, day)], SLICE_REQUESTS)
    pending = pending_slices(expand_slices(request), read_ledger(spark, ledger))
    # a request is at most one year of one cab type: 366 days
    wanted = sorted(row["day"] for row in pending.collect())
    if not wanted:
        return BackfillReport("nothing_pending", batch_id)

    folders = ("cab_type", "year", "month", "day")
    in_days = (F.col("cab_type") == cab_type) & _folder_day().isin(*wanted)
    asked = slice_folders(spark, source, [cab_type], year, month, day)
    if not asked:
        return BackfillReport("empty", batch_id)
    volumes = slice_volume(spark, source, folders, in_days, asked).where("bytes > 0").collect()
    days = sorted(date(int(v["year"]), int(v["month"]), int(v["day"])) for v in volumes)
    if not days:
        return BackfillReport("empty", batch_id)
    size = sum(v["bytes"] for v in volumes)
    files = sum(v["files"] for v in volumes)

    lineage = Lineage(
        batch_id=batch_id,
        source_file=slice_path(source, cab_type, year, month, day),
        migration_batch_id=batch_id,
        engine_type=engine_type,
        ingestion_ts=now,
    )
    pending_keys = spark.createDataFrame(
        [(f"{cab_type}#{d:%Y_%m_%d}",) for d in days], "slice_id string"
    )
    try:
        rows = read_aligned(spark, source, [cab_type], year, month, day, keep=in_days)
        rows = rows.select("*", *lineage.columns())
        inside, outside = rows.where(_on_own_day()).drop("folder_day"), rows.where(~_on_own_day())
        # source folders are days, as the table's partitions are
        plan = plan_write(size, files)
        replaced = spark.createDataFrame([(cab_type, d) for d in days], "cab_type string, folder_day date")
        own_days = replaced.select("cab_type", F.col("folder_day").alias(BY_DAY.columns[-1]))
        rows = land(BY_DAY.add_to(inside), table, BY_DAY.columns, plan, replaces=own_days)
        rejected = land(outside, rejects, REJECT_PARTITIONS, replaces=replaced)
    except Exception:
        append_ledger(ledger_rows(pending_keys, FAILED, batch_id, engine, now), ledger)
        raise
    append_ledger(ledger_rows(pending_keys, LANDED, batch_id, engine, now), ledger)
    return BackfillReport(
        "landed", batch_id, len(days), rows, rejected, size, volume_class(size, threshold_bytes)
    )
