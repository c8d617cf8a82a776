"""Benchmark: time of the headline queries, one JSON line on standard output.

Every query is built and run to the end into a sink that discards the rows, so
all columns of all rows are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tripmill.plans.trip_build import BY_MONTH  # noqa: E402
from tripmill.registry import fixtures as fx  # noqa: E402
from tripmill.registry.queries import (  # noqa: E402
    REGISTRY,
    landed_lake,
    source_slices,
    trip_events,
)
from tripmill.session import build_session, scratch_path  # noqa: E402
from tripmill.sinks import land  # noqa: E402

HEADLINES = (
    "stg_trips",
    "quality_filter_trips",
    "quarantine_trips",
    "dq_summary",
    "zone_names",
    "latest_submission",
    "core",
    "fact",
    "duplicate_submissions",
    "top_zones",
    "top_trips",
    "load_profile_by_cab",
    "land_roundtrip",
    "read_slice_year",
    "promote_roundtrip",
    "validation_by_cab",
    "validation_by_month",
    "validation_drift",
    "upsert_three_batches",
    "upsert_latest",
    "fact_incremental",
    "pending_days",
    "slice_gap_runs",
    "ledger_drift",
    "scd2_vendor",
    "check_unique",
    "check_relationship",
    "check_suite",
    "trip_kpis_by_cab",
    "kpi_against_baseline",
    "cumulative_trips_by_day",
    "trips_each_minute",
    "stream_clean",
    "stream_fact",
    "stream_keys",
    "stream_windows",
)


def run_through(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    # start-up of the JVM, the code generator and the Parquet reader
    run_through(fx.lake_trips(spark, sf_dir))
    # what several queries read is made outside the clock, and reported apart
    setup = {
        "lake": timed(lambda: landed_lake(spark, sf_dir)),
        "slices": timed(lambda: source_slices(spark, sf_dir)),
        "events": timed(lambda: trip_events(spark, sf_dir)),
    }

    queries = {
        name: timed(lambda: run_through(REGISTRY[name](spark, sf_dir))) for name in HEADLINES
    }

    # landing alone, from a table that is already in lake form, as a backfill has it
    copy: list[str] = []
    setup["landing_source"] = timed(lambda: copy.append(_lake_copy(spark, sf_dir)))
    source = spark.read.parquet(copy[0])
    rows = source.count()
    landing = timed(
        lambda: land(BY_MONTH.add_to(source), scratch_path(spark, "bench"), BY_MONTH.columns)
    )
    report = {
        "metric": "total time of the headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
        "setup": setup,
        "landing_rows": rows,
        "landing_sec": landing,
        "landing_rows_per_sec": round(rows / landing),
    }
    spark.stop()
    print(json.dumps(report))


def _lake_copy(spark: SparkSession, sf_dir: str) -> str:
    """The trips several times over, minutes apart, in many files as a lake table has them."""
    path = scratch_path(spark, "bench-source")
    copies = int(os.environ.get("BENCH_LANDING_COPIES", "20"))
    once = landed_lake(spark, sf_dir).drop("pickup_month").repartition(16)
    shift = F.expr("INTERVAL '1' MINUTE") * F.col("copy")
    many = once.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    many.withColumn("pickup_datetime", F.col("pickup_datetime") + shift).drop("copy").write.parquet(path)
    return path


if __name__ == "__main__":
    main()
