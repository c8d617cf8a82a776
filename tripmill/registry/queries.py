"""Registered queries: name -> (spark, folder of test tables) -> DataFrame.

Money sums are rounded to cents, because the order of adding doubles is free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.keys import TRIP_KEY, surrogate_key
from tripmill.operators import checks
from tripmill.operators.align import Lineage, align, count_cast_failures
from tripmill.operators.compare import compare_metrics
from tripmill.operators.dedup import keep_latest, latest_first
from tripmill.operators.dimensions import dim_date, dim_zone
from tripmill.operators.drift import row_drift
from tripmill.operators.duplicates import duplicate_report
from tripmill.operators.enrich import (
    FACT_COLUMNS,
    LATEST_FIRST,
    core_submissions,
    core_trips,
    enrich_zones,
    fact_trips,
)
from tripmill.operators.history import (
    at_version,
    dim_as_of,
    dim_current,
    history_schema,
    open_versions,
    scd2_check,
)
from tripmill.operators.kpi import (
    cumulative_of_partials,
    cumulative_trips,
    daily_partials,
    kpi_vs_baseline,
    kpis_of_partials,
    trip_kpis,
)
from tripmill.operators.ledger import (
    classify_volume,
    expand_slices,
    ledger_state,
    pending_slices,
    reconcile,
    record_landed,
    reset_slices,
    slice_gaps,
    slice_status,
    store_reset,
)
from tripmill.operators.profile import (
    load_profile,
    null_profile,
    sample_rows,
    top_rows,
    top_values,
)
from tripmill.operators.quality import (
    dq_issue_summary,
    explode_reasons,
    quality_filter,
    quarantine,
)
from tripmill.operators.slicing import new_since, slice_day, slice_year
from tripmill.operators.staging import stage_trips, stage_vendors
from tripmill.plans.backfill import backfill
from tripmill.plans.suites import WITH_FRESHNESS
from tripmill.plans.trip_build import (
    BY_MONTH,
    FACT_ORDER,
    MARKS,
    refresh_changes,
    refresh_core,
    refresh_fact,
    refresh_history,
    refresh_partials,
)
from tripmill.plans.validation import TOP_TRIP_COLUMNS, report, validate
from tripmill.registry import fixtures as fx
from tripmill.schemas import (
    CAB_TYPES,
    LAKE_TRIPS,
    SLICE_REQUESTS,
    TRIP_COLUMNS,
    TRIP_SLICE,
    VENDORS,
)
from tripmill.session import scratch_path
from tripmill.sinks import (
    land,
    materialize_table,
    plan_write,
    promote,
    register_view,
    sync_schema,
    upsert,
)
from tripmill.sinks.landing import TARGET_FILE_BYTES, LandingPlan
from tripmill.sources import (
    date_spine_over,
    read_aligned,
    read_events_stream,
    read_seed,
    read_slices,
    read_table,
    slice_volume,
)
from tripmill.streaming import (
    first_of_each,
    fold_deltas,
    fold_new,
    read_counts,
    split_late,
    stream_counts,
    stream_deltas,
    stream_split,
    stream_stage,
    stream_to_table,
    trips_per_minute,
)

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def cents(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


def reasons_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("dq_failure_reasons", F.array_join("dq_failure_reasons", ","))


# ---------------------------------------------------------------- staging


@query
def stg_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.staged_trips(spark, sf_dir)


@query
def stg_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.staged_zones(spark, sf_dir)


@query
def stg_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_vendors(fx.source_vendors(spark, sf_dir))


@query
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineage = Lineage("b1", "slices/all/", "m1", "SPARK", datetime(2024, 3, 1))
    return align(fx.source_trips(spark, sf_dir), lineage)


@query
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags ('Y', ' N ') in the role of a number column: none can be cast."""
    trips = fx.source_trips(spark, sf_dir).withColumn("ratecodeid", F.col("store_and_fwd_flag"))
    return count_cast_failures(trips).select("vendorid", "ratecodeid", "total_amount")


@query
def seed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "seed")
    stage_vendors(fx.source_vendors(spark, sf_dir)).write.option("header", True).csv(path)
    return read_seed(spark, path, VENDORS)


@query
def staged_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered view answers SQL."""
    register_view(fx.staged_trips(spark, sf_dir), "tripmill_stg_trip_data")
    return spark.sql(
        "SELECT cab_type, payment_type, count(*) AS trip_count FROM tripmill_stg_trip_data"
        " WHERE total_amount > 0 GROUP BY cab_type, payment_type"
    )


# ---------------------------------------------------------------- quality


@query
def quality_filter_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_filter(fx.staged_trips(spark, sf_dir))


@query
def quarantine_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasons_as_text(quarantine(fx.staged_trips(spark, sf_dir)))


@query
def quarantine_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reasons_as_text(quarantine(fx.staged_trips(spark, sf_dir), complete=True))


@query
def dq_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_reasons(quarantine(fx.staged_trips(spark, sf_dir)))


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = dq_issue_summary(quarantine(fx.staged_trips(spark, sf_dir)))
    return cents(summary, ["total_amount_flagged"])


# ---------------------------------------------------------------- core, fact, dimensions


@query
def zone_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both zone roles, with one zone missing from the lookup."""
    zones = fx.zones_with_gap(spark, sf_dir)
    trips = fx.staged_trips(spark, sf_dir).select(
        *TRIP_KEY, "dropoff_datetime", "total_amount"
    )
    return enrich_zones(trips, zones)


@query
def latest_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = fx.staged_trips(spark, sf_dir).withColumn("trip_id", surrogate_key(*TRIP_KEY))
    order = latest_first(staged, ["trip_id", *TRIP_KEY], LATEST_FIRST)
    return keep_latest(staged, ["trip_id"], order)


@query
def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_trips(fx.staged_trips(spark, sf_dir), fx.zone_lookup(spark, sf_dir))


@query
def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(core(spark, sf_dir))


@query
def dim_date_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_date(date_spine_over(fx.lake_trips(spark, sf_dir), "pickup_datetime"))


@query
def dim_taxi_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zone(fx.staged_zones(spark, sf_dir))


@query
def materialized_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dim-zone")
    dimension = dim_zone(fx.staged_zones(spark, sf_dir))
    materialize_table(dimension, path)
    return read_table(spark, path, dimension.schema)


@query
def duplicate_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_report(fx.staged_trips(spark, sf_dir))


# ---------------------------------------------------------------- slices, profiles


@query
def slice_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.lake_trips(spark, sf_dir)
    return slice_year(trips, "pickup_datetime", 1997, cab_types=["yellow", "green"])


@query
def slice_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_day(fx.lake_trips(spark, sf_dir), "pickup_datetime", date(1998, 6, 15))


@query
def arrived_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips newer than a target that holds the clean trips of two batches."""
    staged = fx.staged_trips(spark, sf_dir)
    target = quality_filter(staged.where("ingestion_ts < TIMESTAMP_NTZ '2024-01-03 00:00:00'"))
    return new_since(staged, target)


@query
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(fx.lake_trips(spark, sf_dir), "pulocationid", 20)


@query
def top_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_rows(fx.lake_trips(spark, sf_dir), "total_amount", 10, TOP_TRIP_COLUMNS)


@query
def sample_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.staged_trips(spark, sf_dir)
    columns = (*TRIP_KEY, *LATEST_FIRST, "total_amount")
    return sample_rows(trips.select(*columns), 1, columns)


@query
def lineage_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("ingestion_ts", "batch_id", "passenger_count", "airport_fee")
    return null_profile(fx.staged_trips(spark, sf_dir), columns)


@query
def load_profile_by_cab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_profile(fx.lake_trips(spark, sf_dir))


# ---------------------------------------------------------------- landing


def landed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake table: all trips landed by cab type and month, once per session."""

    def write(path: str) -> None:
        land(BY_MONTH.add_to(fx.lake_trips(spark, sf_dir, together=True)), path, BY_MONTH.columns, TOGETHER)

    path = fx.kept_path(spark, sf_dir, "lake", write)
    return read_table(spark, path, BY_MONTH.add_to(spark.createDataFrame([], LAKE_TRIPS)).schema)


SLICE_LEVELS = ("cab_type", "year", "month")


def source_slices(spark: SparkSession, sf_dir: str) -> str:
    """Root of the source trips in ``cab_type=/year=/month=`` folders."""

    def write(path: str) -> None:
        trips = fx.source_trips(spark, sf_dir, together=True).withColumns(
            {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
        )
        land(trips, path, SLICE_LEVELS, TOGETHER)

    return fx.kept_path(spark, sf_dir, "slices", write)


@query
def read_slice_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cab types of one year from the partitioned source, in one scan."""
    root = source_slices(spark, sf_dir)
    trips = read_slices(
        spark, root, ["yellow", "green"], "1997", schema=TRIP_SLICE, levels=SLICE_LEVELS
    )
    return align(trips).withColumn("month", F.month("pickup_datetime"))


@query
def read_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices whose files hold other types than the target, month by month."""

    def write(path: str) -> None:
        trips = fx.source_trips(spark, sf_dir).withColumns(
            {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
        )
        kinds = {0: ("double", "bigint"), 1: ("bigint", "int"), 2: ("string", "smallint")}
        for kind, (passengers, vendor) in kinds.items():
            part = trips.where(F.col("month") % 3 == kind).withColumns(
                {"passenger_count": F.col("passenger_count").cast(passengers), "vendorid": F.col("vendorid").cast(vendor)}
            )
            land(part, path, SLICE_LEVELS)

    root = fx.kept_path(spark, sf_dir, "mixed-slices", write)
    return read_aligned(spark, root, ["yellow", "green"], "1997").drop("folder_day")


@query
def backfill_relanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month landed, one day of it reset and landed again: landed and rejected trips.

    Every fifth trip lies in the folder of the day after it was picked up.
    """
    root, table, ledger, rejects = (
        scratch_path(spark, f"relanding-{label}") for label in ("source", "table", "ledger", "rejects")
    )
    trips = fx.source_trips(spark, sf_dir).where(
        "cab_type = 'green' AND pickup_datetime >= '1997-03-01' AND pickup_datetime < '1997-03-31'"
    )
    folder = F.date_add(F.to_date("pickup_datetime"), (F.col("vendorid") * 3 + F.col("payment_type")).cast("int") % 5 % 2)
    land(
        trips.withColumns({"year": F.year(folder), "month": F.month(folder), "day": F.dayofmonth(folder)}),
        root, ("cab_type", "year", "month", "day"),
    )
    run = {"cab_type": "green", "year": "1997", "month": "03"}
    backfill(spark, root, table, ledger, rejects, **run, batch_id="first", now=datetime(2024, 2, 1))
    again = spark.createDataFrame([("green", "1997", "03", "06")], SLICE_REQUESTS)
    store_reset(spark, ledger, again, at=datetime(2024, 2, 2))
    backfill(spark, root, table, ledger, rejects, **run, batch_id="second", now=datetime(2024, 2, 3))
    return _outcomes(spark, table, rejects)


def _outcomes(spark: SparkSession, table: str, rejects: str) -> DataFrame:
    kept = [c.name for c in TRIP_COLUMNS]
    landed = spark.read.parquet(table).select(*kept, F.lit("landed").alias("outcome"))
    rejected = spark.read.parquet(rejects).select(*kept, F.lit("rejected").alias("outcome"))
    return landed.unionByName(rejected)


@query
def backfill_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month landed; then the folder of its 6th day holds the trips of the 7th only, and lands again.

    The 6th day keeps no trip. The folder's files are of another type than the others' by then.
    """
    root, table, ledger, rejects = (
        scratch_path(spark, f"emptied-{label}") for label in ("source", "table", "ledger", "rejects")
    )
    levels = ("cab_type", "year", "month", "day")
    trips = fx.source_trips(spark, sf_dir).where(
        "cab_type = 'yellow' AND pickup_datetime >= '1997-05-01' AND pickup_datetime < '1997-06-01'"
    )
    day = {"year": F.lit(1997), "month": F.lit(5)}
    land(trips.withColumns({**day, "day": F.dayofmonth("pickup_datetime")}), root, levels)
    run = {"cab_type": "yellow", "year": "1997", "month": "05"}
    backfill(spark, root, table, ledger, rejects, **run, batch_id="first", now=datetime(2024, 2, 1))
    strays = trips.where(F.dayofmonth("pickup_datetime") == 7).withColumn("passenger_count", F.col("passenger_count").cast("double"))
    land(strays.withColumns({**day, "day": F.lit(6)}), root, levels)
    again = spark.createDataFrame([("yellow", "1997", "05", "06")], SLICE_REQUESTS)
    store_reset(spark, ledger, again, at=datetime(2024, 2, 2))
    backfill(spark, root, table, ledger, rejects, **run, batch_id="second", now=datetime(2024, 2, 3))
    return _outcomes(spark, table, rejects)


@query
def upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of an unknown cab type, upserted in two rounds; the first round's stay."""
    path = scratch_path(spark, "null-partition")
    trips = fx.staged_trips(spark, sf_dir).select(
        surrogate_key(*TRIP_KEY).alias("trip_id"),
        F.when(F.col("cab_type") != "fhv", F.col("cab_type")).alias("kind"),
        "vendor_id",
    )
    for rest in (0, 1):
        upsert(spark, path, trips.where(F.col("vendor_id") % 2 == rest), "trip_id", ["kind"])
    return read_table(spark, path, trips.schema)


@query
def slice_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every folder has data; bytes depend on the writer and are left out."""
    volumes = classify_volume(slice_volume(spark, source_slices(spark, sf_dir), SLICE_LEVELS))
    return volumes.selectExpr(
        "CAST(cab_type AS STRING) AS cab_type",
        "CAST(year AS INT) AS year",
        "CAST(month AS INT) AS month",
        "volume_class <> 'empty' AS has_data",
    )


@query
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_lake(spark, sf_dir)


@query
def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each landing of a cab type reported; landing twice adds none."""
    path = scratch_path(spark, "relanded")
    trips = BY_MONTH.add_to(fx.lake_trips(spark, sf_dir))
    schema = trips.schema
    counts = [
        (name, land(trips.where(F.col("cab_type") == name), path, BY_MONTH.columns, plan_write(1 << 28)))
        for name in ("yellow", "green", "fhv", "yellow")
    ]
    reported = spark.createDataFrame(counts, "cab_type string, reported bigint").distinct()
    stored = read_table(spark, path, schema).groupBy("cab_type").agg(
        F.count(F.lit(1)).alias("stored")
    )
    return reported.join(stored, "cab_type")


@query
def promote_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of production replaced by the clean trips of stage."""
    stage, production = scratch_path(spark, "stage"), scratch_path(spark, "production")
    lake = landed_lake(spark, sf_dir)
    # each of the three tables has the lake's partitions, so rows are written where they are read
    land(lake, production, BY_MONTH.columns, AS_STORED)
    land(quality_filter(lake), stage, BY_MONTH.columns, AS_STORED)
    window = F.col("pickup_month").between(date(1997, 1, 1), date(1997, 12, 31))
    promote(spark, stage, production, lake.schema, BY_MONTH.columns, window, AS_STORED)
    return read_table(spark, production, lake.schema)


# ---------------------------------------------------------------- validation


@query
def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a copy of the lake that differ, where all counts and sums agree."""

    def write(path: str) -> None:
        odd = (F.col("cab_type") == "green") & (F.col("payment_type") == 2) & (
            F.trunc("pickup_datetime", "MM") == F.lit("1997-03-01").cast("date")
        )
        lake = landed_lake(spark, sf_dir)
        changed = lake.withColumn("store_and_fwd_flag", F.when(odd, "Z").otherwise(F.col("store_and_fwd_flag")))
        land(changed, path, BY_MONTH.columns, AS_STORED)

    lake = landed_lake(spark, sf_dir)
    copy = read_table(spark, fx.kept_path(spark, sf_dir, "drifted", write), lake.schema)
    drift = row_drift(lake, copy, ["vendorid", "pulocationid", "dolocationid"], "pickup_datetime", BY_MONTH.columns)
    return drift.select("side", "copies", *[c.name for c in TRIP_COLUMNS])


@query
def validation_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_metrics(fx.lake_trips(spark, sf_dir), landed_lake(spark, sf_dir))


@query
def validation_by_cab(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {"row_count": "count(*)", "total_amount": "sum(total_amount)"}
    compared = compare_metrics(
        fx.lake_trips(spark, sf_dir),
        landed_lake(spark, sf_dir),
        {"cab_type": "cab_type"},
        metrics,
    )
    sums = ["source_total_amount", "target_total_amount", "delta_total_amount"]
    # + 0.0 turns a rounded -0.0 into 0.0
    return cents(compared, sums).withColumn(
        "delta_total_amount", F.col("delta_total_amount") + F.lit(0.0)
    )


@query
def validation_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder month of the source against event month of the target."""
    source = spark.read.parquet(source_slices(spark, sf_dir))
    keys = {"month": ("month", "month(pickup_datetime)")}
    return compare_metrics(source, landed_lake(spark, sf_dir), keys)


@query
def validation_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_metrics(
        fx.lake_trips(spark, sf_dir),
        landed_lake(spark, sf_dir),
        metrics={"total_amount": "sum(total_amount)"},
    )
    return cents(
        compared.drop("delta_total_amount"), ["source_total_amount", "target_total_amount"]
    )


@query
def validation_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = {"first_pickup": "min(pickup_datetime)", "last_pickup": "max(pickup_datetime)"}
    return compare_metrics(
        fx.lake_trips(spark, sf_dir), landed_lake(spark, sf_dir), metrics=metrics
    )


@query
def validation_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = date(1998, 6, 15)
    return compare_metrics(
        slice_day(fx.lake_trips(spark, sf_dir), "pickup_datetime", day),
        slice_day(landed_lake(spark, sf_dir), "pickup_datetime", day),
    )


@query
def validation_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comparisons of a year, of which the target lacks the fhv trips of June."""
    lake = landed_lake(spark, sf_dir)
    target = lake.where("cab_type <> 'fhv' OR month(pickup_datetime) <> 6")
    return report(validate(lake, target, 1997, date(1997, 6, 15)))


@query
def validation_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target lacks all rows with seven passengers and all green trips."""
    lake = fx.lake_trips(spark, sf_dir)
    target = lake.where("passenger_count <= 6 AND cab_type <> 'green'")
    keys = {"cab_type": "cab_type", "passenger_count": "passenger_count"}
    return compare_metrics(lake, target, keys)


# ---------------------------------------------------------------- incremental tables


BATCH_ENDS = ("2024-01-01", "2024-01-02", "2024-01-03")


def core_in_batches(spark: SparkSession, sf_dir: str, resolve: str) -> str:
    """Path of a core table that was refreshed after each arrival batch."""

    def write(path: str) -> None:
        # a batch reads its own lines of the source, so the trips need not be landed first
        staged = fx.staged_trips(spark, sf_dir)
        zones = fx.staged_zones(spark, sf_dir)
        for end in BATCH_ENDS:
            known = staged.where(F.col("ingestion_ts") <= F.lit(end).cast("timestamp_ntz"))
            refresh_core(known, zones, path, BY_MONTH, resolve)

    return fx.kept_path(spark, sf_dir, f"core-{resolve}", write)


def _core_table(spark: SparkSession, sf_dir: str, resolve: str) -> DataFrame:
    path = core_in_batches(spark, sf_dir, resolve)
    return read_table(spark, path, BY_MONTH.add_to(core(spark, sf_dir)).schema)


@query
def upsert_three_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _core_table(spark, sf_dir, "incoming")


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _core_table(spark, sf_dir, "latest")


@query
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact refreshed from the core table twice; the second run adds nothing."""
    path = scratch_path(spark, "fact")
    stored = _core_table(spark, sf_dir, "latest")
    refresh_fact(stored, path, BY_MONTH, plan=AS_STORED)
    refresh_fact(stored, path, BY_MONTH, plan=AS_STORED)
    return read_table(spark, path, BY_MONTH.add_to(fact_trips(stored)).schema)


# The core table has the partitions of the fact table, so facts are written where it is read.
AS_STORED = LandingPlan(None, TARGET_FILE_BYTES, clustered=True)
TOGETHER = LandingPlan(None, TARGET_FILE_BYTES, together=True)


def _each_core(spark: SparkSession, sf_dir: str, root: str) -> Iterator[Column]:
    """Refresh a core table by its marks; yields the arrival of each batch."""
    staged, zones = fx.staged_trips(spark, sf_dir), fx.staged_zones(spark, sf_dir)
    for end in BATCH_ENDS:
        at = F.lit(end).cast("timestamp_ntz")
        refresh_core(staged.where(F.col("ingestion_ts") <= at), zones, f"{root}/core", BY_MONTH, "latest", marks=f"{root}/core-marks")
        yield at


def core_increments(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the core and its marks after three batches."""
    return fx.kept_path(spark, sf_dir, "core-increments", lambda root: list(_each_core(spark, sf_dir, root)))


def increments(spark: SparkSession, sf_dir: str) -> str:
    """Folder of core, fact, partials and their marks after three batches."""

    def write(root: str) -> None:
        core_schema = BY_MONTH.add_to(core(spark, sf_dir)).schema
        fact_schema = BY_MONTH.add_to(fact(spark, sf_dir)).schema
        for at in _each_core(spark, sf_dir, root):
            stored = read_table(spark, f"{root}/core", core_schema)
            refresh_fact(stored, f"{root}/fact", BY_MONTH, marks=f"{root}/fact-marks", plan=AS_STORED)
            facts = read_table(spark, f"{root}/fact", fact_schema)
            # a submission that lost to a stored one changes no figure
            refresh_partials(facts, facts.where(F.col("ingestion_ts") == at), f"{root}/partials", BY_MONTH)

    return fx.kept_path(spark, sf_dir, "increments", write)


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = daily_partials(BY_MONTH.add_to(fact(spark, sf_dir)), BY_MONTH.columns).schema
    return read_table(spark, f"{increments(spark, sf_dir)}/partials", schema)


@query
def core_by_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core refreshed by arrival marks that are kept beside it; equals one full load."""
    path = f"{core_increments(spark, sf_dir)}/core"
    return read_table(spark, path, BY_MONTH.add_to(core(spark, sf_dir)).schema)


@query
def arrival_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark that each refresh of the core left."""
    return read_table(spark, f"{core_increments(spark, sf_dir)}/core-marks", MARKS).select("mark")


@query
def kpis_by_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each day from partials that three batches adjusted; equal a scan of all facts.

    Rounded beyond the four decimals that amounts have, so that no sum lies between two roundings.
    """
    kpis = kpis_of_partials(_partials(spark, sf_dir), ["cab_type", "pickup_date_key"])
    return kpis.withColumns({c: F.round(c, 6) for c in [*KPI_SUMS, "avg_trip_minutes"]})


@query
def cumulative_by_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_of_partials(_partials(spark, sf_dir))


@query
def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows under a new schema: one column gone, one new, one retyped."""
    old = fx.staged_trips(spark, sf_dir).select(*TRIP_KEY, "store_and_fwd_flag", "rate_code_id")
    new = old.drop("store_and_fwd_flag").selectExpr(
        "*", "CAST(rate_code_id AS BIGINT) AS rate_code_id_new", "CAST(0 AS DOUBLE) AS surcharge"
    )
    wanted = new.drop("rate_code_id").withColumnRenamed("rate_code_id_new", "rate_code_id").schema
    return sync_schema(old, wanted)


# ---------------------------------------------------------------- ledger


@query
def expanded_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = fx.year_requests(spark, sf_dir).unionByName(fx.january_requests(spark, sf_dir))
    return expand_slices(requests)


@query
def pending_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = expand_slices(fx.year_requests(spark, sf_dir))
    return pending_slices(keys, fx.ledger(spark, sf_dir))


@query
def ledger_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger state after all pending days of every January have landed."""
    ledger = fx.ledger(spark, sf_dir)
    keys = pending_slices(expand_slices(fx.january_requests(spark, sf_dir)), ledger)
    return record_landed(ledger, keys, "batch_c", "spark", datetime(2024, 2, 3))


@query
def ledger_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reset_slices(
        fx.ledger(spark, sf_dir),
        fx.january_requests(spark, sf_dir),
        "reset_1",
        datetime(2024, 2, 4),
    )


@query
def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_state(fx.ledger(spark, sf_dir))


@query
def slice_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_status(fx.ledger(spark, sf_dir), fx.year_requests(spark, sf_dir))


@query
def slice_gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_gaps(fx.ledger(spark, sf_dir), fx.year_requests(spark, sf_dir))


@query
def ledger_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger against a table that lost every even day of a month."""
    days = fx.trip_days(spark, sf_dir).where("day(day) % 2 = 1")
    return reconcile(fx.ledger(spark, sf_dir), days)


# ---------------------------------------------------------------- history


FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 6, 1)


def vendor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendors = stage_vendors(fx.source_vendors(spark, sf_dir))
    history = open_versions(vendors, "vendor_id", FIRST)
    changed = fx.changed_vendors(spark, sf_dir)
    return scd2_check(history, changed, "vendor_id", ["vendor_name", "status"], SECOND)


@query
def scd2_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_history(spark, sf_dir)


@query
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_as_of(vendor_history(spark, sf_dir), datetime(2024, 3, 1))


@query
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_current(vendor_history(spark, sf_dir))


@query
def scd2_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, kept on disk between the two runs."""
    path = scratch_path(spark, "history")
    tracked = ["vendor_name", "status"]
    vendors = stage_vendors(fx.source_vendors(spark, sf_dir))
    refresh_history(spark, vendors, path, "vendor_id", tracked, FIRST)
    changed = fx.changed_vendors(spark, sf_dir)
    return refresh_history(spark, changed, path, "vendor_id", tracked, SECOND)


CHANGING = ("vendor_name", "status")


def changed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of vendors whose changes came late, out of order, and partly twice."""
    changes = fx.vendor_changes(spark, sf_dir)

    def write(root: str) -> None:
        # each batch lies in files of its own, as batches arrive
        changes.write.option("compression", "zstd").partitionBy("batch").parquet(f"{root}/changes")
        arrived = read_table(spark, f"{root}/changes", changes.schema)
        for batch in (2, 0, 1, 0):
            refresh_changes(
                spark, arrived.where(F.col("batch") == batch), f"{root}/observations", f"{root}/history",
                "vendor_id", CHANGING, "changed_at", stable=True,
            )

    path = fx.kept_path(spark, sf_dir, "changes", write)
    return read_table(spark, f"{path}/history", history_schema(changes.select("vendor_id", *CHANGING).schema))


@query
def scd2_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_history(spark, sf_dir).drop("key_bucket")


@query
def fact_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the status that their vendor had when they began."""
    # the hashed key follows from the others, so it is not carried along
    trips = fact(spark, sf_dir).select(*TRIP_KEY, "total_amount")
    found = at_version(trips, changed_history(spark, sf_dir), "vendor_id", "pickup_datetime", ["status"])
    return found.select(
        surrogate_key(*TRIP_KEY).alias("trip_id"), "vendor_id", "pickup_datetime", "total_amount", "version_from", "version_status"
    )


# ---------------------------------------------------------------- checks


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["vendor_id", "passenger_count", "airport_fee"]
    return checks.check_not_null(fx.staged_trips(spark, sf_dir), columns, "stg_trip_data")


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_unique(fx.staged_trips(spark, sf_dir), TRIP_KEY, "stg_trip_data")


@query
def repeated_trip_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.failing_unique(fx.staged_trips(spark, sf_dir), TRIP_KEY)


@query
def check_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_in_set(
        fx.staged_trips(spark, sf_dir), "cab_type", ["yellow", "green"], "stg_trip_data"
    )


@query
def check_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = fx.staged_trips(spark, sf_dir)
    specs = [
        checks.between("passenger_count", minimum=1, maximum=6),
        checks.between("trip_distance", minimum=0, strict=True),
        checks.between("fare_amount", maximum=50000),
    ]
    return checks.run_checks({"stg_trip_data": staged}, {"stg_trip_data": specs})


@query
def check_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_relationship(
        fx.staged_trips(spark, sf_dir),
        "pickup_location_id",
        fx.zones_with_gap(spark, sf_dir),
        "location_id",
    )


@query
def orphan_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.failing_relationship(
        fx.staged_trips(spark, sf_dir),
        "dropoff_location_id",
        fx.zones_with_gap(spark, sf_dir),
        "location_id",
    )


@query
def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_freshness(
        fx.staged_trips(spark, sf_dir),
        warn_after=timedelta(hours=24),
        error_after=timedelta(hours=48),
        now=datetime(2024, 1, 4, 6, 30),
    )


@query
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All assertions of all models, each model scanned once; staged trips are not landed for it."""
    core_table = _core_table(spark, sf_dir, "latest")
    zones = dim_zone(fx.staged_zones(spark, sf_dir))
    frames = {
        "stg_trip_data": fx.staged_trips(spark, sf_dir),
        "int_trip_data_core": core_table,
        "fact_trip": fact_trips(core_table),
        "dim_taxi_zone": zones,
        "dim_date": dim_date(date_spine_over(core_table, "pickup_datetime")),
        "snap_vendor": vendor_history(spark, sf_dir),
        "vendor": stage_vendors(fx.source_vendors(spark, sf_dir)),
    }
    return checks.run_checks(frames, WITH_FRESHNESS, now=datetime(2024, 1, 4, 6, 30))


# ---------------------------------------------------------------- key figures


KPI_SUMS = ["total_fare_revenue", "total_amount"]


@query
def trip_kpis_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = trip_kpis(fact(spark, sf_dir))
    return cents(kpis, [*KPI_SUMS, "avg_trip_minutes"])


@query
def trip_kpis_by_cab(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = trip_kpis(fact(spark, sf_dir), ["cab_type", "time_of_day"])
    return cents(kpis, [*KPI_SUMS, "avg_trip_minutes"])


@query
def kpi_against_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fact(spark, sf_dir)
    compared = kpi_vs_baseline(
        slice_year(trips, "pickup_datetime", 1998),
        slice_year(trips, "pickup_datetime", 1997),
        figures=("trip_count", "total_fare_revenue"),
    )
    sums = [f"{side}_total_fare_revenue" for side in ("current", "baseline", "delta")]
    return cents(compared, [*sums, "trip_count_change_pct"])


@query
def kpi_figures_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four figures of a year against those of the year before."""
    trips = fact(spark, sf_dir)
    compared = kpi_vs_baseline(
        slice_year(trips, "pickup_datetime", 1998),
        slice_year(trips, "pickup_datetime", 1997),
        bucket="day_of_week",
    )
    rounded = [
        f"{side}_{figure}"
        for side in ("current", "baseline", "delta")
        for figure in ("total_fare_revenue", "avg_trip_minutes")
    ]
    return cents(compared, [*rounded, "trip_count_change_pct"])


@query
def cumulative_trips_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_trips(fact(spark, sf_dir), "day")


@query
def trips_each_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_per_minute(fx.staged_trips(spark, sf_dir), by=["cab_type"])


@query
def events_each_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_per_minute(fx.table(spark, sf_dir, "events"), "ts", ["event_type"])


# ---------------------------------------------------------------- streams


MICRO_BATCHES = 4
EVENTS_PER_FILE = 500_000


def trip_events(spark: SparkSession, sf_dir: str) -> str:
    """Folder of trip events as compressed JSON lines; files are bounded, and their number grows with the input."""

    def write(path: str) -> None:
        # several files in no order of time, so that each micro-batch has trips of all days
        lines = fx.table(spark, sf_dir, "lineitem").count()
        most = max(1, min(EVENTS_PER_FILE, -(-lines // MICRO_BATCHES)))
        writer = fx.lake_trips(spark, sf_dir).write.option("maxRecordsPerFile", most)
        writer.option("ignoreNullFields", False).option("compression", "gzip").json(path)

    return fx.kept_path(spark, sf_dir, "trip-events", write)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = trip_events(spark, sf_dir)
    files = len(spark.read.schema(LAKE_TRIPS).json(path).inputFiles())
    return read_events_stream(spark, path, max_files_per_trigger=max(1, -(-files // MICRO_BATCHES)))


def _stream_result(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    stream_to_table(stream, path, scratch_path(spark, f"{label}-checkpoint"))
    return read_table(spark, path, stream.schema)


@query
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = stream_stage(_event_stream(spark, sf_dir))
    return _stream_result(spark, clean, "stream-clean")


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, broken = stream_stage(_event_stream(spark, sf_dir))
    return reasons_as_text(_stream_result(spark, broken, "stream-quarantine"))


@query
def stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact from several micro-batches of events, folded twice; equals one full load."""
    path, deltas = scratch_path(spark, "stream-fact"), scratch_path(spark, "stream-fact-deltas")
    zones = fx.zone_lookup(spark, sf_dir)
    clean, _ = stream_stage(_event_stream(spark, sf_dir))
    schema = BY_MONTH.add_to(fact(spark, sf_dir)).schema
    stream_deltas(
        clean,
        # brought together while they have few columns, so that the fold need not
        lambda batch: BY_MONTH.add_to(fact_trips(core_submissions(BY_MONTH.gather(batch), zones))),
        deltas,
        scratch_path(spark, "stream-fact-checkpoint"),
        TOGETHER,
    )
    fold_deltas(spark, deltas, schema, path, "trip_id", BY_MONTH.columns, FACT_ORDER, gathered=True)
    stored = read_table(spark, path, schema)
    return stored.select(*FACT_COLUMNS)


@query
def stream_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that remain after repeated submissions were dropped from the stream.

    Each batch stores its own keys; two folds bring them into the table.
    """
    clean, _ = stream_stage(_event_stream(spark, sf_dir))
    columns = BY_MONTH.add_to(clean.withColumn("trip_id", surrogate_key(*TRIP_KEY)).select("trip_id", *TRIP_KEY))
    path, deltas = (scratch_path(spark, label) for label in ("stream-keys", "stream-keys-deltas"))
    stream_deltas(columns, first_of_each("trip_id"), deltas, scratch_path(spark, "stream-keys-checkpoint"))
    fold_new(spark, deltas, columns.schema, path, "trip_id", BY_MONTH.columns)
    return read_table(spark, path, columns.schema).select("trip_id", *TRIP_KEY)


@query
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per hour of the stream over all its batches, for windows a day before its end."""
    path = scratch_path(spark, "stream-windows")
    stream_counts(
        _event_stream(spark, sf_dir), path, scratch_path(spark, "stream-windows-checkpoint"),
        by=["cab_type"], width="1 hour",
    )
    last = fx.lake_trips(spark, sf_dir).agg(F.max("pickup_datetime")).first()[0]
    return read_counts(spark, path, ["cab_type"], last - timedelta(days=1))


def _split_stream(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    paths = [scratch_path(spark, label) for label in ("stream-in-time", "stream-late")]
    staged = stage_trips(_event_stream(spark, sf_dir))
    stream_split(staged, *paths, scratch_path(spark, "stream-split-checkpoint"), "9500 DAYS")
    return read_table(spark, paths[late], staged.schema).drop("micro_batch")


@query
def stream_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_stream(spark, sf_dir, late=False)


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly the rows of the stream that the rows in time are not."""
    return _split_stream(spark, sf_dir, late=True)


@query
def trips_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_late(fx.staged_trips(spark, sf_dir), "9500 DAYS")[0]


@query
def trips_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_late(fx.staged_trips(spark, sf_dir), "9500 DAYS")[1]
