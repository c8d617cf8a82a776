from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import values

from tripmill.operators.checks import (
    between,
    check_between,
    check_freshness,
    check_in_set,
    check_not_null,
    check_relationship,
    check_unique,
    failing_between,
    failing_in_set,
    failing_not_null,
    failing_relationship,
    failing_unique,
    run_checks,
)
from tripmill.operators.compare import compare_metrics
from tripmill.operators.profile import load_profile, null_profile, sample_rows, top_rows, top_values
from tripmill.plans.models import register_models
from tripmill.plans.suites import SUITES
from tripmill.plans.validation import validate
from tripmill.registry import queries
from tripmill.schemas import VENDORS, ZONES


def failures(result) -> list[int]:
    return [r["failures"] for r in result.collect()]


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [(1, 0.0), (1, 1.0), (2, 6.0), (None, 7.0), (3, None), (None, None)], "k int, v double"
    )


def test_there_are_52_assertions():
    assert sum(len(checks) for checks in SUITES.values()) == 52
    assert {m: len(c) for m, c in SUITES.items() if m in ("stg_trip_data", "int_trip_data_core")} == {
        "stg_trip_data": 8,
        "int_trip_data_core": 17,
    }


def test_only_not_null_looks_at_nulls(numbers):
    assert failures(check_not_null(numbers, ["k", "v"])) == [2, 2]
    assert failures(check_unique(numbers, ["k"])) == [1]
    assert failures(check_in_set(numbers, "k", [1, 2])) == [1]
    assert failures(check_between(numbers, "v", 0, 6)) == [1]
    assert failures(check_between(numbers, "v", 0, 6, strict=True)) == [3]
    assert failures(check_between(numbers, "v", minimum=1)) == [1]
    assert failures(check_relationship(numbers, "k", numbers.where("k = 1"), "k")) == [2]


def test_failing_rows(numbers):
    assert failing_not_null(numbers, "k").count() == 2
    assert values(failing_in_set(numbers, "k", [1, 2]), "k") == [3]
    assert values(failing_between(numbers, "v", 0, 6), "v") == [7.0]
    assert [tuple(r) for r in failing_unique(numbers, ["k"]).collect()] == [(1, 2)]
    orphans = failing_relationship(numbers, "k", numbers.where("k > 1"), "k")
    assert [tuple(r) for r in orphans.collect()] == [(1, 2)]


def test_between_needs_a_bound(numbers):
    with pytest.raises(ValueError, match="minimum or a maximum"):
        run_checks({"t": numbers}, {"t": [between("v")]})


def test_freshness(staged):
    rows = staged({})
    limits = {"warn_after": timedelta(hours=24), "error_after": timedelta(hours=48)}
    for hours, status in ((24, "pass"), (25, "warn"), (49, "error")):
        now = datetime(2024, 2, 1) + timedelta(hours=hours)
        row = check_freshness(rows, now=now, **limits).first()
        assert (row["status"], row["age_minutes"]) == (status, hours * 60)
    assert check_freshness(rows, now=datetime(2030, 1, 1)).first()["status"] == "pass"
    assert check_freshness(rows.limit(0), now=datetime(2024, 2, 1)).first()["status"] == "error"


def test_comparison_reports_missing_keys_and_null_keys(spark):
    source = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "k string, v double")
    target = spark.createDataFrame([("a", 1.0), ("c", 2.0), (None, 3.5)], "k string, v double")
    result = compare_metrics(source, target, {"k": "k"}, {"n": "count(*)", "total": "sum(v)"})
    rows = {r["k"]: r for r in result.collect()}
    assert rows["a"]["matches"] and rows["a"]["delta_total"] == 0.0
    assert (rows["b"]["target_n"], rows["b"]["matches"]) == (None, False)
    assert (rows["c"]["source_n"], rows["c"]["matches"]) == (None, False)
    assert (rows[None]["delta_total"], rows[None]["matches"]) == (0.5, False)


def test_comparison_of_doubles_has_a_tolerance(spark):
    source = spark.createDataFrame([(0.1 + 0.2,)], "v double")
    target = spark.createDataFrame([(0.3,)], "v double")
    metrics = {"total": "sum(v)"}
    assert compare_metrics(source, target, metrics=metrics).first()["matches"]
    assert not compare_metrics(source, target, metrics=metrics, tolerance=0.0).first()["matches"]


def test_comparison_of_two_empty_tables(spark):
    empty = spark.createDataFrame([], "k string, v double")
    row = compare_metrics(empty, empty, metrics={"n": "count(*)", "total": "sum(v)"}).first()
    assert (row["source_n"], row["matches"]) == (0, True)


def test_folder_month_against_event_month(spark, lake):
    source = lake({}, {}).selectExpr("*", "2 AS month")
    result = compare_metrics(source, lake({}), {"month": ("month", "month(pickup_datetime)")})
    assert {r["month"]: r["matches"] for r in result.collect()} == {1: False, 2: False}


def test_validation_of_an_equal_copy(lake):
    rows = lake({}, {"cab_type": "green", "total_amount": 9.0})
    results = validate(rows, rows, 2024, date(2024, 1, 5), ["yellow", "green"])
    for name in ("count", "count_by_cab", "count_by_month", "sum", "sum_by_cab", "range", "day"):
        assert all(r["matches"] for r in results[name].collect()), name
    assert results["source_top_trips"].collect() == results["target_top_trips"].collect()
    assert results["source_top_zones"].collect() == results["target_top_zones"].collect()
    assert set(results["lineage_nulls"].first().asDict().values()) == {0}


def test_profiles(lake, staged):
    rows = lake({}, {"batch_id": None}, {"cab_type": "green"})
    assert null_profile(rows).first()["batch_id_nulls"] == 1
    assert [(r["cab_type"], r["record_count"]) for r in load_profile(rows).collect()] == [
        ("green", 1),
        ("yellow", 2),
    ]


def test_top_values_and_rows_break_ties(lake):
    rows = lake(*[{"pulocationid": z, "total_amount": a} for z, a in ((3, 5.0), (1, 5.0), (2, 9.0))])
    assert [r["pulocationid"] for r in top_values(rows, "pulocationid", 2).collect()] == [1, 2]
    top = top_rows(rows, "total_amount", 2, ["pulocationid", "total_amount"]).collect()
    assert [tuple(r) for r in top] == [(2, 9.0), (1, 5.0)]
    assert sample_rows(rows, 1, ["pulocationid"]).first()["pulocationid"] == 1
    assert sample_rows(rows).count() == 1


def test_models_answer_sql(spark, lake):
    zones = spark.createDataFrame([(10, "Queens", "Astoria", "Boro Zone")], ZONES)
    vendors = spark.createDataFrame([(1, "A", "Active")], VENDORS)
    register_models(
        lake_trips=lake({}, {"passenger_count": 9}, {"vendorid": 2}), zones=zones, vendors=vendors
    )
    assert spark.sql("SELECT count(*) FROM fact_trip").first()[0] == 2
    assert spark.sql("SELECT trip_count FROM dq_trip_issue_summary").first()[0] == 1
    joined = spark.sql(
        "SELECT f.trip_id FROM fact_trip f JOIN dim_taxi_zone z"
        " ON f.pickup_location_id = z.location_id JOIN dim_date d ON d.date_key = f.pickup_date_key"
        " JOIN stg_vendor v ON v.vendor_id = f.vendor_id WHERE v.status = 'active'"
    )
    assert joined.count() == 1


def test_the_suite_of_all_models_lands_no_trips_but_the_core(spark, tmp_path, monkeypatch):
    tables = {
        "lineitem": ["id AS l_orderkey", "id + 5 AS l_partkey", "id AS l_suppkey", "CAST(id AS INT) AS l_linenumber", "5D AS l_quantity",
                     "3000D AS l_extendedprice", "0.1D AS l_discount", "0.1D AS l_tax", "'A' AS l_returnflag", "'O' AS l_linestatus"],
        "orders": ["id AS o_orderkey", "id AS o_custkey", "TIMESTAMP_NTZ '1997-03-05 00:00:00' AS o_orderdate"],
        "customer": ["id AS c_custkey", "1 AS c_nationkey"],
        "supplier": ["id AS s_suppkey", "'S' AS s_name", "2 AS s_nationkey"],
        "nation": ["CAST(id AS INT) AS n_nationkey", "'N' AS n_name", "0 AS n_regionkey"],
        "region": ["CAST(id AS INT) AS r_regionkey", "'R' AS r_name"],
    }
    for name, columns in tables.items():
        spark.range(5).selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries, "landed_lake", lambda *_: pytest.fail("the lake was landed"))
    monkeypatch.setattr(queries, "_core_table", lambda spark, sf_dir, _: queries.core(spark, sf_dir))
    assert "failures" in queries.REGISTRY["check_suite"](spark, str(tmp_path)).columns
