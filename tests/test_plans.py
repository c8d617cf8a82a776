"""The physical plans that scale: pruning, few shuffles, no hot task."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR, plan_text
from pyspark.sql import functions as F

from tripmill.functions.keys import TRIP_KEY
from tripmill.operators.checks import failing_relationship, row_level_results
from tripmill.operators.dedup import keep_latest
from tripmill.operators.duplicates import duplicate_report, submission_statistics
from tripmill.operators.enrich import checked_lookup, core_trips
from tripmill.operators.kpi import cumulative_trips
from tripmill.operators.profile import top_rows
from tripmill.operators.quality import dq_issue_summary, quality_filter, quarantine
from tripmill.operators.slicing import new_since, slice_year
from tripmill.operators.staging import stage_trips
from tripmill.plans.suites import STAGED_TRIPS
from tripmill.registry.queries import REGISTRY
from tripmill.schemas import LAKE_TRIPS
from tripmill.session import build_session, scratch_root
from tripmill.sources import read_table

LAZY = [
    n for n in REGISTRY
    if not re.match(
        r"(stream|land|promote|upsert|fact_inc|seed|materialized|scd2_stored|validation"
        r"|check_suite|read_|slice_vol|backfill)", n
    )
]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Lake trips on disk, so that plans start with a real scan."""
    from conftest import DEFAULT_TRIP

    path = str(tmp_path_factory.mktemp("lake") / "trips")
    row = tuple(DEFAULT_TRIP[f.name] for f in LAKE_TRIPS.fields)
    spark.createDataFrame([row], LAKE_TRIPS).write.parquet(path)
    return read_table(spark, path, LAKE_TRIPS)


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange (hash|range|Single)", plan_text(df)))


def test_quality_filter_reaches_the_scan(table):
    plan = plan_text(quality_filter(stage_trips(table)))
    assert "GreaterThan(total_amount,0.0)" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "Exchange" not in plan


def test_summary_reads_six_columns_and_aggregates_before_its_shuffle(table):
    plan = plan_text(dq_issue_summary(quarantine(stage_trips(table))))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema.count(":") <= 6
    assert "partial_count" in plan


def test_core_has_one_shuffle_and_keeps_one_row_per_key_before_it(table, zones):
    core = core_trips(stage_trips(table), checked_lookup(zones, "location_id"))
    plan = plan_text(core)
    assert shuffles(core) == 1
    assert plan.count("BroadcastHashJoin") == 2
    partial = plan.index("row_number(), 1, Partial")
    assert partial > plan.index("Exchange hashpartitioning(pickup_datetime")
    assert "md5" not in plan[partial:]


def test_filters_on_key_columns_pass_the_deduplication(table, zones):
    core = core_trips(stage_trips(table), zones)
    plan = plan_text(slice_year(core, "pickup_datetime", 2024, cab_types=["green"]))
    assert "GreaterThanOrEqual(pickup_datetime,2024-01-01T00:00" in plan


def test_deduplication_by_other_keys_is_limited_too(table):
    plan = plan_text(keep_latest(stage_trips(table), list(TRIP_KEY), ["dropoff_datetime"]))
    assert "row_number(), 1, Partial" in plan


def test_year_slice_is_a_range_for_parquet(table):
    plan = plan_text(slice_year(table, "pickup_datetime", 2024))
    assert "GreaterThanOrEqual(pickup_datetime,2024-01-01T00:00" in plan
    assert "LessThan(pickup_datetime,2025-01-01T00:00" in plan


def test_arrival_mark_reaches_the_scan(table):
    plan = plan_text(new_since(table, table))
    assert "GreaterThan(ingestion_ts,ScalarSubquery" in plan
    assert "CartesianProduct" not in plan


def test_top_rows_do_not_sort_everything(table):
    plan = plan_text(top_rows(table, "total_amount", 10, ["vendorid", "total_amount"]))
    assert "TakeOrderedAndProject" in plan
    assert "struct<vendorid:int,total_amount:double>" in plan


def test_row_level_checks_share_one_pass(table):
    plan = plan_text(row_level_results("stg", stage_trips(table), STAGED_TRIPS))
    assert plan.count("FileScan") == 1


def test_relationship_counts_before_the_join(table, zones):
    plan = plan_text(failing_relationship(stage_trips(table), "pickup_location_id", zones, "location_id"))
    assert plan.index("LeftAnti") < plan.index("partial_count")


def test_duplicates_meet_by_key_and_salt(spark, table):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(duplicate_report(stage_trips(table)))
        # the statistics are aggregated in a job of their own, which is stored
        statistics = plan_text(submission_statistics(stage_trips(table)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_salt", plan)) == 2
    assert "partial_count" in statistics


def test_running_totals_see_buckets_only(table):
    plan = plan_text(cumulative_trips(stage_trips(table), "hour"))
    assert plan.index("Window") < plan.index("partial_count")
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_no_python(spark, name):
    plan = plan_text(REGISTRY[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_a_key_with_half_of_all_rows(spark):
    """Same result as without the hot key's weight, whatever task it lands in."""
    rows = spark.range(200_000).selectExpr(
        "IF(id % 2 = 0, 0, id) AS k", "id AS v", "id % 7 AS w"
    )
    kept = keep_latest(rows, ["k"], ["v", "w"])
    assert kept.count() == 100_001
    assert kept.where("k = 0").first()["v"] == 199_998


def test_salted_report_of_a_hot_key(spark, table):
    staged = stage_trips(table)
    amounts = F.sequence(F.lit(0), F.lit(29_999)).cast("array<double>")
    hot = staged.withColumn("total_amount", F.explode(amounts))
    report = duplicate_report(hot.unionByName(hot.where("total_amount < 5")))
    assert report.count() == 30_005
    row = report.first()
    assert (row["submission_count"], row["fare_variance"]) == (30_005, 29_999.0)


def test_scratch_folder_is_the_configured_one(spark, monkeypatch):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class OnCluster:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(OnCluster())


def test_session_defaults(spark):
    assert build_session().conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
