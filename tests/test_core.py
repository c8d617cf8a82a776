from __future__ import annotations

import hashlib
from datetime import date, datetime

import pytest
from conftest import same_rows, values
from pyspark.sql import functions as F

from tripmill.functions import minute_boundaries, surrogate_key, truncate
from tripmill.functions.keys import TRIP_KEY
from tripmill.operators import enrich
from tripmill.operators.dedup import keep_latest
from tripmill.operators.dimensions import dim_date
from tripmill.operators.duplicates import duplicate_report
from tripmill.operators.enrich import (
    DuplicateLookupKey,
    checked_lookup,
    core_trips,
    enrich_zones,
    fact_trips,
)
from tripmill.sources import date_spine, date_spine_over


def test_key_is_the_md5_of_the_joined_text(staged):
    key = staged({"vendorid": None}).select(surrogate_key(*TRIP_KEY)).first()[0]
    text = "_dbt_utils_surrogate_key_null_-yellow-2024-01-05 08:00:00-10-20"
    assert key == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, staged, zone):
    """02:30 does not exist in New York on this day."""
    before = spark.conf.get("spark.sql.session.timeZone")
    trip = {"pickup_datetime": datetime(2024, 3, 10, 2, 30, 59)}
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = staged({**trip, "dropoff_datetime": datetime(2024, 3, 10, 4, 0, 1)}).select(
            surrogate_key(*TRIP_KEY).alias("key"),
            minute_boundaries(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("m"),
            truncate(F.col("pickup_datetime"), "hour").alias("h"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    text = "1-yellow-2024-03-10 02:30:59-10-20"
    assert row["key"] == hashlib.md5(text.encode()).hexdigest()
    assert (row["m"], row["h"]) == (90, datetime(2024, 3, 10, 2))


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("10:00:59", "10:01:01", 1),
        ("10:00:00", "10:00:59", 0),
        ("10:01:01", "10:00:59", -1),
        ("23:59:59", "00:00:00", -1439),
    ],
)
def test_minutes_count_boundaries(spark, start, end, minutes):
    df = spark.sql(
        f"SELECT TIMESTAMP_NTZ '2024-01-01 {start}' AS a, TIMESTAMP_NTZ '2024-01-01 {end}' AS b"
    )
    assert df.select(minute_boundaries(F.col("a"), F.col("b"))).first()[0] == minutes


def test_latest_dropoff_wins(staged, zones):
    rows = staged(
        {"dropoff_datetime": datetime(2024, 1, 5, 8, 20), "total_amount": 1.0},
        {"dropoff_datetime": datetime(2024, 1, 5, 8, 40), "total_amount": 2.0},
    )
    result = core_trips(rows, zones).collect()
    assert [(r["total_amount"], r["trip_duration_minutes"]) for r in result] == [(2.0, 40)]


def test_ties_are_resolved_the_same_way_in_any_order(staged):
    same_end = [{"total_amount": v} for v in (3.0, 9.0, 5.0)]
    order = ["dropoff_datetime", "total_amount"]
    for rows in (same_end, same_end[::-1]):
        kept = keep_latest(staged(*rows), list(TRIP_KEY), order)
        assert values(kept, "total_amount") == [9.0]


def test_a_broken_row_does_not_displace_a_clean_one(staged, zones):
    rows = staged(
        {"dropoff_datetime": datetime(2024, 1, 5, 9, 0), "passenger_count": 9}, {}
    )
    assert values(core_trips(rows, zones), "passenger_count") == [2]


def test_unknown_zones_stay_with_null_names(staged, zones):
    row = enrich_zones(staged({"dolocationid": 99}), zones).first()
    assert (row["pickup_zone"], row["dropoff_zone"]) == ("astoria", None)


def test_lookup_must_be_unique(zones):
    with pytest.raises(DuplicateLookupKey):
        checked_lookup(zones.unionByName(zones), "location_id")


def test_lookup_over_the_bound_is_not_broadcast(spark, zones, staged, monkeypatch):
    def broadcast_hints(lookup) -> int:
        return enrich_zones(staged({}), lookup)._jdf.queryExecution().analyzed().toString().count(
            "strategy=broadcast"
        )

    assert broadcast_hints(checked_lookup(zones, "location_id")) == 2
    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 1)
    large = checked_lookup(zones, "location_id")
    assert broadcast_hints(large) == 0
    assert enrich_zones(staged({}), large).first()["pickup_zone"] == "astoria"
    with pytest.raises(DuplicateLookupKey):
        checked_lookup(zones.unionByName(zones), "location_id")


def test_fact_measures(staged, zones):
    rows = staged(
        {"vendorid": 1, "pulocationid": 132},
        {"vendorid": 2, "fare_amount": 0.0, "dolocationid": 138},
        {"vendorid": 3, "pulocationid": None, "pickup_datetime": datetime(2024, 1, 5, 3)},
    )
    fact = {r["vendor_id"]: r for r in fact_trips(core_trips(rows, zones)).collect()}
    assert fact[1]["tip_pct"] == 20.0
    assert fact[2]["tip_pct"] is None
    assert [fact[v]["is_airport_trip"] for v in (1, 2, 3)] == [True, True, False]
    assert [fact[v]["time_of_day"] for v in (1, 3)] == ["morning", "late_night"]
    assert fact[1]["pickup_date_key"] == date(2024, 1, 5)
    assert not {"batch_id", "source_file", "migration_batch_id", "engine_type"} & set(
        fact[1].asDict()
    )


@pytest.mark.parametrize(
    ("hour", "part"),
    [(5, "late_night"), (6, "morning"), (9, "morning"), (10, "afternoon"), (15, "afternoon"),
     (16, "evening"), (19, "evening"), (20, "night"), (23, "night"), (0, "late_night")],
)
def test_parts_of_the_day(spark, hour, part):
    from tripmill.functions import time_of_day

    moment = F.lit(f"2024-01-01 {hour:02d}:59:59").cast("timestamp_ntz")
    assert spark.range(1).select(time_of_day(moment)).first()[0] == part


def test_default_calendar(spark):
    calendar = dim_date(date_spine(spark))
    rows = calendar.collect()
    assert len(rows) == 3650
    assert (rows[0]["date_key"], rows[-1]["date_key"]) == (date(2020, 1, 1), date(2029, 12, 28))
    sunday = calendar.where("date_key = '2024-12-29'").first()
    assert (sunday["day_of_week"], sunday["week_of_year"], sunday["day_name"]) == (0, 52, "Sun")
    monday = calendar.where("date_key = '2024-12-30'").first()
    assert (monday["day_of_week"], monday["week_of_year"], monday["quarter"]) == (1, 1, 4)


def test_calendar_over_data(staged):
    rows = staged({}, {"pickup_datetime": datetime(2024, 1, 8, 23)})
    assert date_spine_over(rows, "pickup_datetime").count() == 4


def test_duplicates_keep_every_submission(staged):
    rows = staged(
        {"total_amount": 10.0, "dropoff_datetime": datetime(2024, 1, 5, 8, 10, 59)},
        {"total_amount": 14.0, "dropoff_datetime": datetime(2024, 1, 5, 8, 12, 1)},
        {"total_amount": 14.0, "dropoff_datetime": datetime(2024, 1, 5, 8, 12, 1)},
        {"vendorid": 2},
        {"vendorid": None},
        {"vendorid": None},
    )
    report = duplicate_report(rows)
    assert report.count() == 3
    row = report.first()
    assert (row["submission_count"], row["fare_variance"]) == (3, 4.0)
    assert row["dropoff_variance_minutes"] == 2


def test_duplicates_do_not_depend_on_the_number_of_salts(staged):
    rows = staged(*[{"vendorid": i % 3, "tip_amount": float(i)} for i in range(30)])
    assert same_rows(duplicate_report(rows, salts=1), duplicate_report(rows, salts=5))
    assert duplicate_report(rows).count() == 30
