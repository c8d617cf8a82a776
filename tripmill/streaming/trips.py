"""Operators on streams of trips; most work on batch frames as well."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.operators.dedup import keep_latest, latest_first
from tripmill.operators.quality import TRIP_RULES, Rule, quality_filter, quarantine
from tripmill.operators.staging import stage_trips
from tripmill.session import scoped_conf
from tripmill.sinks.landing import LandingPlan, write_settings
from tripmill.sinks.tables import written_copy
from tripmill.sinks.upsert import MAX_FILES_A_PARTITION, touched_partitions, upsert
from tripmill.sources.files import delete_folder, path_exists
from tripmill.sources.tables import read_table


def stream_stage(
    events: DataFrame, rules: Sequence[Rule] = TRIP_RULES, complete: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Staged clean rows and quarantined rows; both stateless."""
    staged = stage_trips(events)
    return quality_filter(staged, rules), quarantine(staged, rules, complete)


def with_event_time(df: DataFrame, column: str = "pickup_datetime") -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone gives the zone."""
    return df.withColumn("event_time", F.col(column).cast("timestamp"))


def trips_per_minute(
    df: DataFrame,
    column: str = "pickup_datetime",
    by: Sequence[str] = (),
    width: str = "1 minute",
    delay: str = "10 minutes",
) -> DataFrame:
    """Rows per tumbling window, for a batch frame or a stream.

    On a stream a window is emitted once the watermark has passed its end, and its
    state is dropped then: rows behind the watermark are not counted. Use
    :func:`stream_counts` where every row must count, however late it is.
    """
    if df.isStreaming:
        timed = with_event_time(df, column).withWatermark("event_time", delay)
    else:
        timed = df.withColumn("event_time", F.col(column))
    counts = timed.groupBy(F.window("event_time", width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("trips")
    )
    return counts.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *by,
        "trips",
    )


def stream_dedup(
    stream: DataFrame,
    key: Sequence[str],
    delay: str = "1 hour",
    column: str = "pickup_datetime",
) -> DataFrame:
    """Drop repeated submissions that arrive within the delay.

    The first arrival is kept; rows behind the watermark are dropped as well, new
    keys among them. Use :func:`stream_insert_new` where no key may be lost, and
    :func:`stream_deltas` where the latest submission must win.
    """
    timed = with_event_time(stream, column).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(key)).drop("event_time")


def split_late(
    df: DataFrame,
    delay: str,
    event_column: str = "pickup_datetime",
    arrival_column: str = "ingestion_ts",
) -> tuple[DataFrame, DataFrame]:
    """Rows that arrived in time, and rows later than the delay.

    To be applied before a stateful operator, which would drop late rows
    silently. Rows without one of the two times count as late.
    """
    limit = F.expr(f"INTERVAL {delay}")
    in_time = F.coalesce(
        F.col(arrival_column) <= F.col(event_column) + limit, F.lit(False)
    )
    return df.where(in_time), df.where(~in_time)


def stream_to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Process everything available into a Parquet table, exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()


def _each_batch(
    stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]
) -> None:
    (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder for each micro-batch; a repeated batch replaces its own."""
    (
        df.withColumn("micro_batch", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("micro_batch")
        .parquet(path)
    )


def stream_counts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    column: str = "pickup_datetime",
    by: Sequence[str] = (),
    width: str = "1 minute",
) -> None:
    """Counts per window of every micro-batch; :func:`read_counts` adds them up.

    There is no watermark and no state: a late row is counted in a later batch's
    part of the same window, so the sums do not depend on how files are cut into
    batches. What is stored is bounded by windows and batches, not by rows.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        _write_batch(trips_per_minute(batch, column, by, width), path, batch_id)

    _each_batch(stream, checkpoint, apply)


def read_counts(
    spark: SparkSession, path: str, by: Sequence[str] = (), closed_before: datetime | None = None
) -> DataFrame:
    """Rows per window over all batches, optionally only of windows that have ended."""
    parts = spark.read.parquet(path)
    if closed_before is not None:
        parts = parts.where(F.col("window_end") <= F.lit(str(closed_before)).cast("timestamp_ntz"))
    return parts.groupBy("window_start", "window_end", *by).agg(F.sum("trips").alias("trips"))


def stream_insert_new(
    stream: DataFrame, path: str, checkpoint: str, key: str, partition_by: Sequence[str]
) -> None:
    """Append the rows whose key the table does not hold yet.

    The table remembers every key, so nothing is lost behind a watermark and a
    repeated micro-batch adds nothing. The partition columns must be functions of
    the key: only the partitions that a batch touches are read, and only their keys.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        new = keep_latest(batch, [key], latest_first(batch, [key], ()))
        if path_exists(spark, path):
            stored = read_table(spark, path, batch.schema).select(key, *partition_by)
            new = written_copy(new, "stream-insert")
            known = touched_partitions(stored, new, partition_by).select(key)
            new = new.join(known, key, "left_anti")
        new.write.mode("append").partitionBy(*partition_by).parquet(path)

    _each_batch(stream, checkpoint, apply)


def stream_split(
    stream: DataFrame,
    in_time: str,
    late: str,
    checkpoint: str,
    delay: str,
    event_column: str = "pickup_datetime",
    arrival_column: str = "ingestion_ts",
) -> None:
    """Store rows in time and late rows side by side; together they are the stream."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        both = split_late(batch, delay, event_column, arrival_column)
        for rows, path in zip(both, (in_time, late), strict=True):
            _write_batch(rows, path, batch_id)

    _each_batch(stream, checkpoint, apply)


def stream_deltas(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    plan: LandingPlan | None = None,
) -> None:
    """Store the transformed rows of every micro-batch, without touching a keyed table.

    :func:`fold_deltas` brings them into the table on its own schedule, so a batch
    costs its own rows and not the partitions that they belong to. A ``transform`` may bring
    the rows of a partition together (``Grain.gather``) while they have few columns; ``plan`` is for that.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # rebalancing is adaptive, which a stream's own session may have switched off
        settings = {"spark.sql.adaptive.enabled": "true", **write_settings(plan)} if plan else {}
        with scoped_conf(batch.sparkSession, settings):
            _write_batch(transform(batch), path, batch_id)

    _each_batch(stream, checkpoint, apply)


def fold_deltas(
    spark: SparkSession,
    deltas: str,
    schema: T.StructType,
    table: str,
    key: str,
    partition_by: Sequence[str],
    order: Sequence[str],
    gathered: bool = False,
) -> int:
    """Upsert all stored deltas in one go, latest row wins, then drop them.

    An interrupted run can be repeated: rows that were folded already are the same
    submissions. No stream may write the deltas meanwhile. ``gathered`` says that each batch
    brought the rows of a partition together; with few batches they are not shuffled again.
    """
    if not path_exists(spark, deltas):
        return 0
    stored = read_table(spark, deltas, schema).select(*schema.names)
    batches = {f.rsplit("/", 2)[-2] for f in stored.inputFiles()}
    rows = upsert(
        spark, table, stored, key, partition_by, resolve="latest", order=order, stable=True,
        gathered=gathered and len(batches) <= MAX_FILES_A_PARTITION,
    )
    delete_folder(spark, deltas)
    return rows


def first_of_each(key: str) -> Callable[[DataFrame], DataFrame]:
    """A transform that keeps one row of each key of a batch."""
    return lambda batch: keep_latest(batch, [key], latest_first(batch, [key], ()))


def fold_new(
    spark: SparkSession,
    deltas: str,
    schema: T.StructType,
    table: str,
    key: str,
    partition_by: Sequence[str],
) -> int:
    """Append the rows of all stored deltas whose key the table does not hold, then drop the deltas.

    Of a key's rows the first batch's stays, so the first arrival wins. The table's keys are read
    once a fold, not once a batch, and only those of the partitions that the deltas touch; nothing is
    lost behind a watermark. Repeating an interrupted run adds nothing. The partition columns must be
    functions of the key. Returns the rows appended.
    """
    if not path_exists(spark, deltas):
        return 0
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("micro_batch", T.LongType())])).parquet(deltas)
    first = stored.groupBy(key).agg(F.min_by(F.struct(*schema.names), "micro_batch").alias("row"))
    new = first.select("row.*").select(*schema.names)
    if path_exists(spark, table):
        new = written_copy(new, "fold-new")
        known = read_table(spark, table, schema).select(key, *partition_by)
        new = new.join(touched_partitions(known, new, partition_by).select(key), key, "left_anti")
    counted = Observation()
    new = new.select(*schema.names).observe(counted, F.count(F.lit(1)).alias("rows"))
    new.write.mode("append").partitionBy(*partition_by).parquet(table)
    delete_folder(spark, deltas)
    return counted.get["rows"]


def stream_upsert(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    key: str,
    partition_by: Sequence[str],
    order: Sequence[str],
) -> None:
    """Upsert every micro-batch into a keyed table, latest row wins.

    The query's checkpoint takes the place of an arrival high-water mark. A
    micro-batch that is repeated after a failure changes nothing, because the
    upsert is idempotent.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        upsert(
            batch.sparkSession,
            path,
            transform(batch),
            key,
            partition_by,
            resolve="latest",
            order=order,
        )

    _each_batch(stream, checkpoint, apply)
