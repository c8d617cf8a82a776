"""Ledger of landed slices: one row per event, the latest row is the status.

The ledger is append-only, so recording is one small write, a repeated write
changes nothing, and writers do not overwrite each other.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.functions import slice_id, utc_now
from tripmill.schemas import LEDGER
from tripmill.sources.files import path_exists
from tripmill.sources.tables import read_table

LANDED = "LANDED"
PENDING = "PENDING"
FAILED = "FAILED"
MISSING = "MISSING"

# Fixed value: source bytes above which a slice counts as high volume.
HIGH_VOLUME_BYTES = int(0.05 * 1024**3)


def _part(column: str) -> Column:
    """A request part; the text ``none`` and the empty text mean absent."""
    text = F.lower(F.trim(F.col(column).cast("string")))
    return F.when(text.isin("none", ""), None).otherwise(text).cast("int")


def expand_slices(requests: DataFrame) -> DataFrame:
    """Year, month and day requests as distinct day keys.

    Columns of ``requests``: cab_type, year, month, day; month and day may be
    NULL. A day without a month is rejected.
    """
    parts = requests.select(
        F.lower("cab_type").alias("cab_type"),
        _part("year").alias("year"),
        _part("month").alias("month"),
        _part("day").alias("day"),
    )
    first = F.make_date(
        "year", F.coalesce("month", F.lit(1)), F.coalesce("day", F.lit(1))
    )
    last = (
        F.when(
            F.col("month").isNull() & F.col("day").isNotNull(),
            F.raise_error(F.lit("a day needs a month")).cast("date"),
        )
        .when(F.col("day").isNotNull(), first)
        .when(F.col("month").isNotNull(), F.last_day(first))
        .otherwise(F.make_date("year", F.lit(12), F.lit(31)))
    )
    days = parts.select("cab_type", F.explode(F.sequence(first, last)).alias("day"))
    return days.distinct().select(
        slice_id(F.col("cab_type"), F.col("day")).alias("slice_id"), "cab_type", "day"
    )


def ledger_state(ledger: DataFrame) -> DataFrame:
    """Latest ledger row of each slice."""
    row = F.struct("landed_at", "status", "batch_id", "engine")
    latest = ledger.groupBy("slice_id").agg(F.max(row).alias("row"))
    return latest.select("slice_id", "row.batch_id", "row.status", "row.engine", "row.landed_at")


def pending_slices(keys: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requested day keys that are not landed yet."""
    landed = ledger_state(ledger).where(F.col("status") == LANDED).select("slice_id")
    return keys.join(landed, "slice_id", "left_anti")


def ledger_rows(
    keys: DataFrame, status: str, batch_id: str, engine: str | None, at: datetime | None = None
) -> DataFrame:
    """Ledger rows that give every key a status."""
    moment = utc_now() if at is None else F.lit(str(at))
    return keys.select(
        "slice_id",
        F.lit(batch_id).cast("string").alias("batch_id"),
        F.lit(status).alias("status"),
        F.lit(engine).cast("string").alias("engine"),
        moment.cast("timestamp_ntz").alias("landed_at"),
    )


def record_landed(
    ledger: DataFrame, keys: DataFrame, batch_id: str, engine: str, at: datetime | None = None
) -> DataFrame:
    """State of the ledger after the keys have landed. Rows are kept forever."""
    return ledger_state(ledger.unionByName(ledger_rows(keys, LANDED, batch_id, engine, at)))


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one before the first landing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return read_table(spark, path, LEDGER)


def reset_slices(
    ledger: DataFrame, requests: DataFrame, batch_id: str = "reset", at: datetime | None = None
) -> DataFrame:
    """State of the ledger after the requested days were set to be done again."""
    pending = ledger_rows(expand_slices(requests), PENDING, batch_id, None, at)
    return ledger_state(ledger.unionByName(pending))


def store_reset(
    spark: SparkSession,
    path: str,
    requests: DataFrame,
    batch_id: str = "reset",
    at: datetime | None = None,
) -> None:
    """Set the requested days to be done again, in the stored ledger."""
    append_ledger(ledger_rows(expand_slices(requests), PENDING, batch_id, None, at), path)


def slice_status(ledger: DataFrame, requests: DataFrame) -> DataFrame:
    """Every requested day with its status; days without a row are missing."""
    return (
        expand_slices(requests)
        .join(ledger_state(ledger), "slice_id", "left")
        .select(
            "slice_id",
            "cab_type",
            "day",
            F.coalesce("status", F.lit(MISSING)).alias("status"),
            "batch_id",
            "engine",
            "landed_at",
        )
    )


def slice_gaps(ledger: DataFrame, requests: DataFrame) -> DataFrame:
    """Runs of consecutive days that are not landed, per cab type and status."""
    open_days = slice_status(ledger, requests).where(F.col("status") != LANDED)
    # one group holds calendar days, never trips
    run = Window.partitionBy("cab_type", "status").orderBy("day")
    runs = open_days.withColumn("_run", F.date_sub("day", F.row_number().over(run)))
    return runs.groupBy("cab_type", "status", "_run").agg(
        F.min("day").alias("gap_start"),
        F.max("day").alias("gap_end"),
        F.count(F.lit(1)).alias("days"),
    ).drop("_run")


def reconcile(ledger: DataFrame, landed_days: DataFrame) -> DataFrame:
    """Drift between the ledger and the days a landed table holds.

    ``landed_days`` has cab_type and day. Reports only, changes nothing.
    """
    claimed = (
        ledger_state(ledger)
        .where(F.col("status") == LANDED)
        .select("slice_id", F.lit(True).alias("in_ledger"))
    )
    present = landed_days.select(
        slice_id(F.col("cab_type"), F.col("day")).alias("slice_id")
    ).distinct().withColumn("in_table", F.lit(True))
    drift = (
        F.when(F.col("in_table").isNull(), "LANDED_WITHOUT_DATA")
        .when(F.col("in_ledger").isNull(), "DATA_WITHOUT_LEDGER")
    )
    return (
        claimed.join(present, "slice_id", "full_outer")
        .select("slice_id", drift.alias("drift"))
        .where("drift IS NOT NULL")
    )


def volume_class(size: int, threshold_bytes: int = HIGH_VOLUME_BYTES) -> str:
    return "high" if size > threshold_bytes else "low" if size > 0 else "empty"


def classify_volume(volumes: DataFrame, threshold_bytes: int = HIGH_VOLUME_BYTES) -> DataFrame:
    """Volume class of each slice, from its bytes."""
    size = F.coalesce(F.col("bytes"), F.lit(0))
    label = F.when(size > threshold_bytes, "high").when(size > 0, "low").otherwise("empty")
    return volumes.withColumn("volume_class", label)
