"""Incremental core and fact tables, and the vendor history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import surrogate_key, truncate, utc_now
from tripmill.operators.enrich import (
    CORE_COLUMNS,
    FACT_COLUMNS,
    checked_lookup,
    core_order,
    core_submissions,
    fact_trips,
)
from tripmill.operators.history import history_of_ordered, history_schema, ordered_changes, scd2_check
from tripmill.operators.kpi import daily_partials
from tripmill.operators.slicing import arrived_after, new_since
from tripmill.schemas import struct
from tripmill.session import scoped_conf
from tripmill.sinks import land, upsert
from tripmill.sinks.landing import TARGET_FILE_BYTES, LandingPlan
from tripmill.sinks.tables import written_copy
from tripmill.sinks.upsert import touched_partitions
from tripmill.sources import path_exists, read_table
from tripmill.sources.files import delete_folder


@dataclass(frozen=True)
class Grain:
    """Partitioning of a trip table: by cab type and by day or month of pickup.

    Both derive from the trip key, so a key never changes its partition.
    """

    unit: str
    column: str

    @property
    def columns(self) -> list[str]:
        return ["cab_type", self.column]

    def value(self) -> Column:
        return truncate(F.col("pickup_datetime"), self.unit).cast("date")

    def add_to(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, self.value())

    def gather(self, df: DataFrame) -> DataFrame:
        """Staged rows of a partition side by side: what is derived from them later is not shuffled."""
        return self.add_to(df).hint("rebalance", *[F.col(c) for c in self.columns])


# A day of trips fills many files at full scale; a month suits small tables.
BY_DAY = Grain("day", "pickup_date")
BY_MONTH = Grain("month", "pickup_month")

CORE_ORDER = tuple(core_order(list(CORE_COLUMNS)))
FACT_ORDER = tuple(
    core_order([c for c in CORE_COLUMNS if c in FACT_COLUMNS])
)


# All a refresh needs to know about what it has stored: when that arrived.
ARRIVALS = struct(ingestion_ts="timestamp_ntz")


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return read_table(spark, path, schema) if path_exists(spark, path) else None


# Arrival marks: one row for each refresh, written after its data.
MARKS = struct(mark="timestamp_ntz", noted_at="timestamp_ntz")


def read_mark(spark: SparkSession, marks: str) -> datetime | None:
    """The latest arrival that a refresh has stored; None before the first."""
    stored = _existing(spark, marks, MARKS)
    return None if stored is None else stored.agg(F.max("mark")).first()[0]


def _refresh(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    inclusive: bool,
    marks: str | None,
    store: Callable[[DataFrame], int],
) -> int:
    """Store what arrived since the mark, which is asked of the table or, with ``marks``, kept beside it.

    A kept mark is the latest arrival that the reading tasks of the write have seen; it is written
    after the data, so a refresh that breaks off reads the same rows again.
    """
    if marks is None:
        return store(new_since(source, _existing(spark, path, ARRIVALS), inclusive=inclusive))
    mark, seen = read_mark(spark, marks), Observation()
    if mark is not None:
        source = arrived_after(source, F.lit(str(mark)).cast("timestamp_ntz"), inclusive=inclusive)
    rows = store(source.observe(seen, F.max("ingestion_ts").alias("mark")))
    latest = F.lit(str(seen.get["mark"]) if seen.get.get("mark") else None)
    spark.range(1).select(latest.cast("timestamp_ntz").alias("mark"), utc_now().alias("noted_at")).write.mode("append").parquet(marks)
    return rows


def refresh_core(
    staged: DataFrame,
    zones: DataFrame,
    path: str,
    grain: Grain = BY_DAY,
    resolve: str = "incoming",
    inclusive: bool = False,
    marks: str | None = None,
) -> int:
    """Add newly arrived trips to the core table; everything on the first run.

    ``resolve="incoming"`` replaces a stored trip by a later submission even if
    that one has the older dropoff; ``"latest"`` compares the two, and should go
    with ``inclusive``, which reads the newest batch again. ``marks`` names a folder that keeps the
    arrival mark, so that no stored trip is read for it; arrivals that the quality rules reject count too.
    """
    spark = staged.sparkSession
    lookup = checked_lookup(zones, "location_id")

    def store(arrived: DataFrame) -> int:
        rows = grain.add_to(core_submissions(arrived, lookup))
        return upsert(spark, path, rows, "trip_id", grain.columns, resolve, CORE_ORDER)

    return _refresh(spark, staged, path, inclusive, marks, store)


def refresh_fact(
    core: DataFrame,
    path: str,
    grain: Grain = BY_DAY,
    inclusive: bool = False,
    marks: str | None = None,
    plan: LandingPlan | None = None,
) -> int:
    """Add the core rows that arrived since the last refresh to the fact table.

    A ``plan`` with ``clustered`` fits a core table of the same grain: its files keep a partition together.
    """
    spark = core.sparkSession

    def store(arrived: DataFrame) -> int:
        return upsert(spark, path, grain.add_to(fact_trips(arrived)), "trip_id", grain.columns, plan=plan)

    return _refresh(spark, core, path, inclusive, marks, store)


def refresh_partials(fact: DataFrame, changed: DataFrame, path: str, grain: Grain = BY_DAY) -> int:
    """Daily partials of the partitions that ``changed`` trips belong to, replaced from the stored facts.

    ``fact`` holds the grain's columns. Only touched partitions are read, so late trips cost their own
    days (or months); a partition without trips left loses its partials. Running again changes nothing.
    """
    touched = written_copy(grain.add_to(changed).select(*grain.columns).distinct(), "touched-partials")
    partials = daily_partials(touched_partitions(fact, touched, grain.columns), grain.columns)
    return land(partials, path, grain.columns, replaces=touched)


def _versioned(source: T.StructType) -> T.StructType:
    return history_schema(source).add("version", T.IntegerType())


def refresh_history(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    key: str,
    check_columns: Sequence[str],
    now: datetime | str | None = None,
) -> DataFrame:
    """Compare incoming rows with the last stored history and store the next one.

    Each run adds a ``version`` partition and leaves earlier ones alone, so the
    history that is being read is never the one being written.
    """
    stored = _existing(spark, path, _versioned(incoming.schema))
    if stored is None:
        version, previous = 1, None
    else:
        last = stored.agg(F.max("version")).first()[0]
        version, previous = last + 1, stored.where(F.col("version") == last).drop("version")
    history = scd2_check(previous, incoming, key, check_columns, now)
    land(history.withColumn("version", F.lit(version)), path, ["version"])
    return read_history(spark, path, incoming.schema)


# Rows lie by partition in the files or tasks they come from, so they are written there.
WHERE_READ = LandingPlan(None, TARGET_FILE_BYTES, clustered=True)

# Parts of a table of changes; a batch rewrites those that its keys fall into.
KEY_BUCKETS = 64

# What a task that orders changes reads of a shuffle; in memory they take several times of that.
ORDERED_TASK_BYTES = 32 * 1024 * 1024


def refresh_changes(
    spark: SparkSession,
    changes: DataFrame,
    observations: str,
    path: str,
    key: str,
    tracked: Sequence[str],
    at: str,
    buckets: int = KEY_BUCKETS,
    stable: bool = False,
) -> int:
    """Take changes in any order of time into the stored observations, and rebuild the history they touch.

    Batches may come late, twice, or in any order: the history is the same. Observations are kept with
    those that changed nothing, because a change that arrives late may lie before them. They are stored
    with the versions they open, so the rows of touched buckets are shuffled once, and the history is
    written where they are read. ``stable`` says that ``changes`` is read from files that stay as they
    are, so that no copy of it is needed. Returns the versions of the rebuilt key buckets.
    """
    bucket = F.pmod(F.xxhash64(F.col(key), F.col(key).isNull()), F.lit(buckets)).cast("int")
    rows = changes.select(key, *tracked, at).withColumn("key_bucket", bucket)
    if not stable:
        rows = written_copy(rows, "changes")
    known = rows.withColumn("is_known", F.lit(False))
    if path_exists(spark, observations):
        stored = touched_partitions(read_table(spark, observations, rows.schema), rows, ["key_bucket"])
        known = stored.withColumn("is_known", F.lit(True)).unionByName(known)
    unfinished = f"{observations.rstrip('/')}-unfinished"
    broken_off = path_exists(spark, unfinished)
    spark.range(1).write.mode("overwrite").parquet(unfinished)
    ordered = ordered_changes(known, key, tracked, at, F.col("is_known")).withColumn("key_bucket", bucket)
    seen = Observation()
    news = F.collect_set(F.when(F.col("is_news"), F.col("key_bucket")))
    ordered = ordered.observe(seen, news.alias("buckets")).drop("is_news")
    # a task holds a part of every bucket, so that tasks of full size write few files
    sizes = {
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ORDERED_TASK_BYTES),
    }
    with scoped_conf(spark, sizes):
        land(ordered, observations, ["key_bucket"], WHERE_READ)
    kept = read_table(spark, observations, ordered.schema)
    if not broken_off:
        kept = kept.where(F.col("key_bucket").isin(seen.get["buckets"] or []))
    history = history_of_ordered(kept, key, tracked, at)
    rebuilt = land(history.withColumn("key_bucket", bucket), path, ["key_bucket"], WHERE_READ)
    delete_folder(spark, unfinished)
    return rebuilt


def read_history(spark: SparkSession, path: str, source: T.StructType) -> DataFrame:
    """Newest stored version of a history."""
    stored = read_table(spark, path, _versioned(source))
    newest = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == newest).drop("version")
