from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import same_rows, values
from pyspark.sql import functions as F

from tripmill.operators.enrich import core_trips, fact_trips
from tripmill.operators.kpi import cumulative_of_partials, cumulative_trips, daily_partials, kpis_of_partials, trip_kpis
from tripmill.operators.slicing import new_since, slice_by_time, slice_day
from tripmill.plans.trip_build import (
    BY_DAY,
    CORE_ORDER,
    FACT_ORDER,
    read_mark,
    refresh_core,
    refresh_fact,
    refresh_partials,
)
from tripmill.sinks import sync_schema, upsert
from tripmill.sources import read_table

FIRST, SECOND, THIRD = (datetime(2024, 2, d) for d in (1, 2, 3))


def submission(arrived: datetime, minutes: int, amount: float, **changes) -> dict:
    start = datetime(2024, 1, 5, 8)
    return {
        "ingestion_ts": arrived,
        "pickup_datetime": start,
        "dropoff_datetime": start + timedelta(minutes=minutes),
        "total_amount": amount,
        **changes,
    }


LONGER_FIRST = [submission(FIRST, 60, 1.0), submission(SECOND, 30, 2.0)]


@pytest.fixture
def core_table(spark, staged, zones):
    schema = BY_DAY.add_to(core_trips(staged({}), zones)).schema
    return lambda path: read_table(spark, path, schema)


def refresh_in_steps(staged, zones, path, rows, resolve):
    for end in sorted({r["ingestion_ts"] for r in rows}):
        known = [r for r in rows if r["ingestion_ts"] <= end]
        refresh_core(staged(*known), zones, path, resolve=resolve)


@pytest.mark.parametrize(("resolve", "kept"), [("incoming", 2.0), ("latest", 1.0)])
def test_later_batch_with_older_dropoff(staged, zones, tmp_path, core_table, resolve, kept):
    path = str(tmp_path / "core")
    refresh_in_steps(staged, zones, path, LONGER_FIRST, resolve)
    assert values(core_table(path), "total_amount") == [kept]


def test_increments_with_latest_equal_one_full_load(staged, zones, tmp_path, core_table):
    rows = [
        submission(arrived, (i * 7) % 50 + 1, float(i + 1), vendorid=i % 4, pulocationid=i % 3)
        for i, arrived in enumerate([FIRST, SECOND, THIRD] * 6)
    ]
    path = str(tmp_path / "core")
    refresh_in_steps(staged, zones, path, rows, "latest")
    full = BY_DAY.add_to(core_trips(staged(*rows), zones))
    assert same_rows(core_table(path), full)


def test_refreshing_again_changes_nothing(staged, zones, tmp_path, core_table):
    path = str(tmp_path / "core")
    rows = staged(*LONGER_FIRST, submission(SECOND, 5, 9.0, vendorid=2))
    refresh_core(rows, zones, path, resolve="latest")
    before = core_table(path).collect()
    refresh_core(rows, zones, path, resolve="latest", inclusive=True)
    refresh_core(rows, zones, path)
    assert sorted(core_table(path).collect()) == sorted(before)


def test_a_batch_with_the_same_timestamp_needs_the_inclusive_mark(
    staged, zones, tmp_path, core_table
):
    path = str(tmp_path / "core")
    refresh_core(staged(submission(FIRST, 5, 1.0)), zones, path)
    both = staged(submission(FIRST, 5, 1.0), submission(FIRST, 5, 2.0, vendorid=2))
    refresh_core(both, zones, path)
    assert values(core_table(path), "total_amount") == [1.0]
    refresh_core(both, zones, path, inclusive=True)
    assert values(core_table(path), "total_amount") == [1.0, 2.0]


def test_untouched_partitions_keep_their_files(staged, zones, tmp_path, core_table):
    path = str(tmp_path / "core")
    other_day = submission(FIRST, 5, 1.0, pickup_datetime=datetime(2024, 1, 4, 8))
    refresh_core(staged(other_day, submission(FIRST, 5, 2.0)), zones, path)
    before = {f for f in core_table(path).inputFiles() if "2024-01-04" in f}
    refresh_core(staged(submission(SECOND, 6, 3.0)), zones, path)
    after = set(core_table(path).inputFiles())
    assert before <= after
    assert values(core_table(path), "total_amount") == [1.0, 3.0]


def test_many_touched_partitions_are_joined_instead_of_listed(
    staged, zones, tmp_path, core_table, monkeypatch
):
    import importlib

    module = importlib.import_module("tripmill.sinks.upsert")
    monkeypatch.setattr(module, "MAX_LITERAL_PARTITIONS", 1)
    path = str(tmp_path / "core")
    days = [
        submission(FIRST, 5, float(d), pickup_datetime=datetime(2024, 1, d, 8)) for d in (1, 2, 3)
    ]
    refresh_core(staged(*days), zones, path)
    again = [{**d, "ingestion_ts": SECOND, "total_amount": d["total_amount"] + 10} for d in days[:2]]
    refresh_core(staged(*again), zones, path)
    assert values(core_table(path), "total_amount") == [3.0, 11.0, 12.0]


def test_empty_increment(staged, zones, tmp_path, core_table):
    path = str(tmp_path / "core")
    rows = staged(submission(FIRST, 5, 1.0))
    refresh_core(rows, zones, path)
    assert refresh_core(rows, zones, path) == 0
    assert core_table(path).count() == 1


def test_fact_follows_core(spark, staged, zones, tmp_path, core_table):
    core_path, fact_path = str(tmp_path / "core"), str(tmp_path / "fact")
    for end in (1, 2):
        refresh_core(staged(*LONGER_FIRST[:end]), zones, core_path)
        refresh_fact(core_table(core_path), fact_path)
    expected = BY_DAY.add_to(fact_trips(core_table(core_path)))
    assert same_rows(read_table(spark, fact_path, expected.schema), expected)


def test_orders_cover_every_column_that_may_differ(staged, zones):
    core = core_trips(staged({}), zones)
    settled = {"trip_id", "trip_duration_minutes", "vendor_id", "cab_type", "pickup_datetime"}
    names = {c for c in core.columns if not c.endswith(("_zone", "_borough", "_location_id"))}
    assert set(CORE_ORDER) == names - settled
    assert set(FACT_ORDER) <= set(fact_trips(core).columns)


def test_upsert_adds_and_drops_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", 10), (2, "a", 20)], "k int, p string, gone int")
    upsert(spark, path, old, "k", ["p"])
    new = spark.createDataFrame([(2, "x", "a")], "k int, added string, p string")
    upsert(spark, path, new, "k", ["p"])
    stored = read_table(spark, path, new.schema)
    assert sorted((r["k"], r["added"]) for r in stored.collect()) == [(1, None), (2, "x")]


def test_upsert_arguments(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, p string")
    with pytest.raises(ValueError, match="order"):
        upsert(spark, str(tmp_path / "t"), df, "k", ["p"], resolve="latest")
    with pytest.raises(ValueError, match="newest"):
        upsert(spark, str(tmp_path / "t"), df, "k", ["p"], resolve="newest")


def test_schema_sync(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    wanted = spark.createDataFrame([], "a bigint, c double").schema
    synced = sync_schema(old, wanted)
    assert synced.schema == wanted
    assert tuple(synced.first()) == (1, None)


def test_arrivals(staged):
    rows = staged(*LONGER_FIRST)
    stored = rows.where(F.col("ingestion_ts") == F.lit(FIRST))
    assert new_since(rows, None).count() == 2
    assert new_since(rows, stored.limit(0)).count() == 2
    assert new_since(rows, stored).count() == 1
    assert new_since(rows, stored, inclusive=True).count() == 2


def test_slices_are_half_open(staged):
    midnight = datetime(2024, 1, 6)
    rows = staged({}, {"pickup_datetime": midnight})
    day = datetime(2024, 1, 5).date()
    assert slice_day(rows, "pickup_datetime", day).count() == 1
    assert slice_day(rows, "pickup_datetime", day, inclusive=True).count() == 2
    start, end = datetime(2024, 1, 1), datetime(2025, 1, 1)
    assert slice_by_time(rows, "pickup_datetime", start, end, ["green"]).count() == 0


def test_slices_prune_partition_folders(staged, tmp_path, core_table, zones):
    path = str(tmp_path / "core")
    refresh_core(staged(submission(FIRST, 5, 1.0)), zones, path)
    day = datetime(2024, 1, 5).date()
    sliced = slice_day(
        core_table(path), "pickup_datetime", day, partition_column="pickup_date"
    )
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert "GreaterThanOrEqual(pickup_datetime" in plan
    assert sliced.count() == 1


def test_null_partitions_keep_their_rows(spark, tmp_path):
    schema = "trip_id string, kind string, n int"
    path = str(tmp_path / "t")
    for rows in ([("k1", None, 1), ("k2", "a", 1)], [("k3", None, 2)], [("k1", None, 3), ("k1", None, 2)]):
        upsert(spark, path, spark.createDataFrame(rows, schema), "trip_id", ["kind"])
    got = spark.read.schema(schema).parquet(path)
    assert sorted((r.trip_id, r.n) for r in got.collect()) == [("k1", 3), ("k2", 1), ("k3", 2)]


def test_arrivals_are_utc_in_every_session_zone(spark):
    from tripmill.functions import utc_now

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        there = spark.range(1).select(utc_now().alias("t")).first().t
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        here = spark.range(1).select(utc_now().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((here - there).total_seconds()) < 600


# ---------------------------------------------------------------- kept marks


def test_kept_mark_reads_no_stored_trip(spark, staged, zones, tmp_path, core_table):
    path, marks = str(tmp_path / "core"), str(tmp_path / "marks")
    assert read_mark(spark, marks) is None
    refresh_core(staged(submission(FIRST, 5, 1.0)), zones, path, marks=marks)
    assert read_mark(spark, marks) == FIRST
    # a stored trip of a later arrival would move a mark that is asked of the table
    later = submission(THIRD, 5, 9.0, vendorid=2, pickup_datetime=datetime(2024, 1, 9))
    BY_DAY.add_to(core_trips(staged({**later, "dropoff_datetime": datetime(2024, 1, 9, 1)}), zones)).write.mode(
        "append").partitionBy(*BY_DAY.columns).parquet(path)
    both = staged(submission(FIRST, 5, 1.0), submission(SECOND, 5, 2.0, vendorid=3))
    refresh_core(both, zones, path, marks=marks)
    assert values(core_table(path), "total_amount") == [1.0, 2.0, 9.0]
    assert read_mark(spark, marks) == SECOND


def test_kept_mark_survives_an_empty_batch_and_rows_without_arrival(spark, staged, zones, tmp_path, core_table):
    path, marks = str(tmp_path / "core"), str(tmp_path / "marks")
    rows = staged(submission(SECOND, 5, 1.0))
    refresh_core(rows, zones, path, marks=marks)
    assert refresh_core(rows, zones, path, marks=marks) == 0
    refresh_core(staged(submission(None, 5, 3.0, vendorid=4)), zones, path, marks=marks)
    assert values(core_table(path), "total_amount") == [1.0, 3.0]
    assert read_mark(spark, marks) == SECOND


# ---------------------------------------------------------------- kept partials


def day_trips(day: int, arrived: datetime, *amounts: float) -> list[dict]:
    start = datetime(2024, 1, day, 8)
    return [
        submission(arrived, 5, a, pickup_datetime=start, dropoff_datetime=start + timedelta(minutes=7), pulocationid=i)
        for i, a in enumerate(amounts)
    ]


def test_partials_follow_late_trips_and_leave_other_days(spark, staged, zones, tmp_path):
    path = str(tmp_path / "partials")
    first = [*day_trips(4, FIRST, 1.0, 2.0), *day_trips(5, FIRST, 3.0)]
    late = day_trips(4, SECOND, 10.0)
    facts = lambda rows: BY_DAY.add_to(fact_trips(core_trips(staged(*rows), zones)))
    schema = daily_partials(facts(first), BY_DAY.columns).schema
    refresh_partials(facts(first), staged(*first), path)
    before = {f for f in read_table(spark, path, schema).inputFiles() if "2024-01-05" in f}
    # the late trip replaces one of the first two
    refresh_partials(facts([*first, *late]), staged(*late), path)
    refresh_partials(facts([*first, *late]), staged(*late), path)
    stored = read_table(spark, path, schema)
    assert before and before <= set(stored.inputFiles())
    trips = facts([*first, *late])
    assert same_rows(kpis_of_partials(stored), trip_kpis(trips))
    assert same_rows(kpis_of_partials(stored, ["cab_type"]), trip_kpis(trips, ["cab_type"]))
    assert same_rows(cumulative_of_partials(stored), cumulative_trips(trips, "day"))


def test_partials_of_a_day_without_trips_are_gone(spark, staged, zones, tmp_path):
    path = str(tmp_path / "partials")
    rows = [*day_trips(4, FIRST, 1.0), *day_trips(5, FIRST, 3.0)]
    facts = BY_DAY.add_to(fact_trips(core_trips(staged(*rows), zones)))
    refresh_partials(facts, staged(*rows), path)
    refresh_partials(facts.where("pickup_date <> '2024-01-04'"), staged(*rows[:1]), path)
    stored = read_table(spark, path, daily_partials(facts, BY_DAY.columns).schema)
    assert [(str(r["pickup_date_key"]), r["trip_count"]) for r in stored.collect()] == [("2024-01-05", 1)]


def test_figures_of_no_partials(staged, zones):
    facts = fact_trips(core_trips(staged({}), zones)).limit(0)
    assert same_rows(kpis_of_partials(daily_partials(facts)), trip_kpis(facts))


def test_an_upsert_shuffles_no_stored_row_whose_key_is_single(spark, tmp_path, monkeypatch):
    """Stored rows stay in the tasks that read them; only the batch and repeated keys are dealt anew."""
    import importlib

    module, path, landed = importlib.import_module("tripmill.sinks.upsert"), str(tmp_path / "t"), []
    real = module.land

    def land(df, *args, settled=None, **kwargs):
        landed.append((df.count(), 0 if settled is None else settled.count()))
        assert settled is None or "rebalance" not in settled._jdf.queryExecution().logical().toString().lower()
        return real(df, *args, settled=settled, **kwargs)

    monkeypatch.setattr(module, "land", land)
    rows = lambda first, last, n: spark.range(first, last).selectExpr("id AS k", "id % 3 AS p", f"{n} AS n")
    upsert(spark, path, rows(0, 90, 1), "k", ["p"])
    # of the batch's 20 rows ten replace a stored one each, which therefore is not settled
    for resolve in ("incoming", "latest"):
        assert upsert(spark, path, rows(80, 100, 2), "k", ["p"], resolve, ["n"]) >= 100
    assert landed == [(90, 0), (20, 80), (20, 80)]
    stored = read_table(spark, path, "k long, p long, n int")
    assert sorted((r.k, r.n) for r in stored.collect()) == [(k, 1 if k < 80 else 2) for k in range(100)]


@pytest.mark.parametrize("resolve", ["incoming", "latest"])
def test_rows_without_key_and_repeated_keys_of_a_batch(spark, tmp_path, resolve):
    path, schema = str(tmp_path / "t"), "k string, p string, n int"
    for rows in ([(None, "a", 1), (None, "a", 2), ("x", "a", 1), ("x", "a", 3)], [(None, "a", 4), ("x", "a", 2), ("y", "a", 1), ("y", "a", 0)]):
        upsert(spark, path, spark.createDataFrame(rows, schema), "k", ["p"], resolve, ["n"])
    got = sorted((r.k or "", r.n) for r in read_table(spark, path, schema).collect())
    # a row without a key never equals another when the incoming row wins, as before
    kept = [("", 2), ("", 4), ("x", 2)] if resolve == "incoming" else [("", 4), ("x", 3)]
    assert got == [*kept, ("y", 1)]


def test_many_files_of_a_partition_are_gathered(spark, tmp_path, monkeypatch):
    import importlib

    monkeypatch.setattr(importlib.import_module("tripmill.sinks.upsert"), "MAX_FILES_A_PARTITION", 2)
    path = str(tmp_path / "t")
    for n in range(6):
        upsert(spark, path, spark.createDataFrame([(n, "a")], "k int, p string"), "k", ["p"])
    table = read_table(spark, path, "k int, p string")
    assert sorted(r.k for r in table.collect()) == list(range(6))
    assert len(table.inputFiles()) <= 3


@pytest.mark.parametrize("resolve", ["incoming", "latest"])
@pytest.mark.parametrize("bitmap_bytes", [32 << 20, 4096])
def test_many_repeated_keys_shuffle_no_single_row(spark, tmp_path, monkeypatch, resolve, bitmap_bytes):
    """Beyond the hashes that are broadcast a bitmap of them is; a full one only passes more rows as repeated."""
    import importlib

    module, path = importlib.import_module("tripmill.sinks.upsert"), str(tmp_path / "t")
    monkeypatch.setattr(module, "MAX_BROADCAST_HASHES", 2)
    monkeypatch.setattr(module, "MAX_BITMAP_BYTES", bitmap_bytes)
    splits, real = [], module._splitter

    def splitter(frames, key):
        split = real(frames, key)

        def watched(df):
            single, several = split(df)
            assert "Exchange hashpartitioning" not in single._jdf.queryExecution().executedPlan().toString()
            splits.append((df.count(), single.count(), several.count()))
            return single, several

        return watched

    monkeypatch.setattr(module, "_splitter", splitter)
    rows = lambda first, last, n: spark.range(first, last).selectExpr("IF(id = 7, NULL, id) AS k", "id % 3 AS p", f"{n} AS n")
    upsert(spark, path, rows(0, 3000, 1).unionByName(rows(10, 40, 2)), "k", ["p"], resolve, ["n"])
    upsert(spark, path, rows(1000, 4000, 3), "k", ["p"], resolve, ["n"])
    stored = read_table(spark, path, "k long, p long, n int").where("k IS NOT NULL").collect()
    expected = {k: 3 if k >= 1000 else 2 if 10 <= k < 40 else 1 for k in range(4000) if k != 7}
    assert {r.k: r.n for r in stored} == expected and len(stored) == len(expected)
    assert all(total == single + several for total, single, several in splits)
    # the first load has 60 rows of repeated keys
    assert 60 <= splits[0][2] < 80 and splits[2][2] >= 2000
