"""Idempotent landing into partitioned Parquet tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.session import scoped_conf
from tripmill.sources.files import delete_folder, path_exists
from tripmill.sources.tables import read_table

TARGET_FILE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class LandingPlan:
    """How a write is spread over tasks and files.

    ``clustered`` means that the source keeps the rows of a partition together
    in files that are big enough already: then the write needs no shuffle.
    ``together`` means that the rows were rebalanced by their partitions before
    columns were derived from them, so that those columns are not shuffled.
    """

    tasks: int | None
    file_bytes: int
    max_records_per_file: int = 0
    clustered: bool = False
    together: bool = False


def plan_write(
    expected_bytes: int | None = None,
    source_files: int | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    max_records_per_file: int = 0,
) -> LandingPlan:
    """Parallelism from the volume to be written instead of a fixed number.

    Give ``source_files`` only if every source file belongs to one partition of
    the target, as in a slice that is already stored by day.
    """
    tasks, clustered = None, False
    if expected_bytes is not None:
        tasks = max(1, math.ceil(expected_bytes / target_file_bytes))
        if source_files:
            clustered = expected_bytes / source_files >= target_file_bytes / 2
    return LandingPlan(tasks, target_file_bytes, max_records_per_file, clustered)


def spread(df: DataFrame, partition_by: Sequence[str], plan: LandingPlan) -> DataFrame:
    """Bring the rows of a partition together, but split partitions that are big.

    A rebalance lets AQE cut one oversized partition (a cab type or day that
    holds a third of all rows) into several tasks; a plain repartition by the
    same columns would give it all to one task.
    """
    if plan.clustered or plan.together:
        return df
    columns = [F.col(c) for c in partition_by]
    if plan.tasks is None:
        return df.hint("rebalance", *columns)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("rebalance", max(plan.tasks, least), *columns)


def write_settings(plan: LandingPlan) -> dict[str, str]:
    """The file size bounds the split of big partitions, or the scan's splits
    where there is no shuffle. Small partitions stay in many tasks: rows of a
    folder meet in one task anyway, so merging tasks would not save a file."""
    # a task sorts its rows by folder, and in memory they take several times their room in a shuffle or file
    if plan.clustered:
        return {"spark.sql.files.maxPartitionBytes": str(max(1, plan.file_bytes // 8))}
    # rows that are completed after their shuffle take still more
    share = 8 if plan.together else 4
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(max(1, plan.file_bytes // share)),
        "spark.sql.files.maxPartitionBytes": str(max(1, plan.file_bytes // 8)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }


def land(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    plan: LandingPlan | None = None,
    replaces: DataFrame | None = None,
    settled: DataFrame | None = None,
) -> int:
    """Replace exactly the partitions present in ``df``; returns the rows written.

    The rows are counted by the writing tasks themselves, after the last
    shuffle, so there is no second pass and a repeated map task counts once.

    ``replaces`` lists partitions (columns ``partition_by``) that the write stands for even if
    it brings no row for them: those are removed, after the data is committed, so an interrupted run
    leaves old rows, never missing ones, and can be repeated. It should be short, as a list of days is.
    ``settled`` are more rows of the same partitions that lie together in the files they come from: they
    are written where they are read, without a shuffle.
    """
    plan = plan or plan_write()
    counted = Observation()
    texts = [F.col(c).cast("string").alias(c) for c in partition_by]
    figures = [F.count(F.lit(1)).alias("rows")]
    if replaces is not None:
        # which partitions got rows, told by the writing tasks as well
        figures.append(F.collect_set(F.to_json(F.struct(*texts))).alias("written"))
    rows = spread(df, partition_by, plan)
    if settled is not None:
        rows = settled.unionByName(rows)
    writer = (
        rows.observe(counted, *figures)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )
    if plan.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", plan.max_records_per_file)
    with scoped_conf(df.sparkSession, write_settings(plan)):
        writer.parquet(path)
    if replaces is not None:
        empty = replaces.select(*partition_by).distinct().where(
            ~F.to_json(F.struct(*texts)).isin(counted.get["written"] or [])
        )
        _drop_partitions(df.sparkSession, path, empty, must_exist=False)
    return counted.get["rows"]


def _drop_partitions(
    spark: SparkSession, path: str, partitions: DataFrame, must_exist: bool = True
) -> int:
    """Delete the folders of the listed partitions; the calendar bounds their number."""
    # Spark's own naming: special characters are escaped, NULL has a name
    naming = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    texts = partitions.select(*[F.col(c).cast("string").alias(c) for c in partitions.columns])
    dropped = 0
    for row in texts.toLocalIterator():
        folder = "/".join(naming.getPartitionPathString(c, row[c]) for c in texts.columns)
        whole = f"{path.rstrip('/')}/{folder}"
        if not must_exist and not path_exists(spark, whole):
            continue
        if not delete_folder(spark, whole):
            raise RuntimeError(f"partition {folder} of {path} could not be deleted")
        dropped += 1
    return dropped


def promote(
    spark: SparkSession,
    stage: str,
    production: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    window: Column,
    plan: LandingPlan | None = None,
) -> int:
    """Replace a window of production by the same window of stage.

    ``window`` must be a predicate on the partition columns. Partitions are
    replaced first; those that stage no longer has are removed afterwards, so an
    interrupted run leaves old rows, never missing ones.
    """
    incoming = read_table(spark, stage, schema).where(window)
    existed = path_exists(spark, production)
    rows = land(incoming, production, partition_by, plan)
    if existed:
        have = read_table(spark, production, schema).where(window)
        stale = (
            have.select(*partition_by)
            .distinct()
            .exceptAll(incoming.select(*partition_by).distinct())
        )
        _drop_partitions(spark, production, stale)
    return rows
