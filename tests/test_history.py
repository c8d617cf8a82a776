from __future__ import annotations

import random
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from tripmill.operators import history as history_module
from tripmill.operators.history import (
    at_version,
    dim_as_of,
    dim_current,
    history_of_changes,
    history_schema,
    open_versions,
    ordered_changes,
    scd2_check,
)
from tripmill.plans import trip_build
from tripmill.plans.trip_build import read_history, refresh_changes, refresh_history
from tripmill.schemas import VENDORS
from tripmill.sources import read_table

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
TRACKED = ["vendor_name", "status"]


@pytest.fixture
def vendors(spark):
    return lambda *rows: spark.createDataFrame(list(rows), VENDORS)


def versions(history) -> list[tuple]:
    rows = history.collect()
    return sorted(
        (r["vendor_id"], r["status"], r["dbt_valid_from"], r["dbt_valid_to"] or datetime.max)
        for r in rows
    )


def test_new_changed_unchanged_and_missing(vendors):
    start = vendors((1, "A", "suspended"), (2, "B", "active"), (4, "D", None))
    history = scd2_check(None, start, "vendor_id", TRACKED, T1)
    later = vendors((1, "A", "active"), (3, "C", "active"), (4, "D", None))
    history = scd2_check(history, later, "vendor_id", TRACKED, T2)
    end = datetime.max
    assert versions(history.where("vendor_id <> 4")) == [
        (1, "active", T2, end),
        (1, "suspended", T1, T2),
        (2, "active", T1, end),
        (3, "active", T2, end),
    ]
    assert history.where("vendor_id = 4").count() == 1


def test_null_changes_are_seen(vendors):
    history = open_versions(vendors((1, "A", None)), "vendor_id", T1)
    history = scd2_check(history, vendors((1, "A", "active")), "vendor_id", TRACKED, T2)
    assert history.count() == 2


def test_running_twice_changes_nothing(vendors):
    rows = vendors((1, "A", "active"))
    history = scd2_check(None, rows, "vendor_id", TRACKED, T1)
    again = scd2_check(history, rows, "vendor_id", TRACKED, T2)
    assert versions(again) == versions(history)


def test_intervals_neither_overlap_nor_leave_gaps(vendors):
    history = None
    for moment, status in ((T1, "active"), (T2, "suspended"), (T3, "active")):
        history = scd2_check(history, vendors((1, "A", status)), "vendor_id", TRACKED, moment)
    rows = sorted(history.collect(), key=lambda r: r["dbt_valid_from"])
    assert [r["dbt_valid_to"] for r in rows] == [T2, T3, None]
    assert [r["dbt_valid_from"] for r in rows] == [T1, T2, T3]
    assert len({r["dbt_scd_id"] for r in rows}) == 3


def test_current_and_past_views(vendors):
    history = open_versions(vendors((1, "A", "suspended")), "vendor_id", T1)
    history = scd2_check(history, vendors((1, "A", "active")), "vendor_id", TRACKED, T2)
    current = dim_current(history).collect()
    assert [(r["status"], r["is_current"], r["valid_from"]) for r in current] == [
        ("active", True, T2)
    ]
    past = dim_as_of(history, datetime(2024, 1, 15)).collect()
    assert [(r["status"], r["is_current"]) for r in past] == [("suspended", False)]
    assert dim_as_of(history, T2).first()["status"] == "active"


def test_stored_history(spark, vendors, tmp_path):
    path = str(tmp_path / "history")
    refresh_history(spark, vendors((1, "A", "suspended")), path, "vendor_id", TRACKED, T1)
    changed = vendors((1, "A", "active"))
    refresh_history(spark, changed, path, "vendor_id", TRACKED, T2)
    refresh_history(spark, changed, path, "vendor_id", TRACKED, T3)
    assert versions(read_history(spark, path, VENDORS)) == [
        (1, "active", T2, datetime.max),
        (1, "suspended", T1, T2),
    ]


# ---------------------------------------------------------------- changes in any order

CHANGES = "vendor_id int, vendor_name string, status string, at timestamp_ntz"


@pytest.fixture
def changes(spark):
    return lambda *rows: spark.createDataFrame(list(rows), CHANGES)


def by_hand(rows) -> list[tuple]:
    """Versions of observations, key by key in order of time."""
    best: dict = {}
    for key, name, status, at in rows:
        value = ((name is not None, name or ""), (status is not None, status or ""))
        best[key, at] = max(best.get((key, at), value), value)
    out = []
    for key in {k for k, _ in best}:
        times = sorted(at for k, at in best if k == key)
        kept = [t for i, t in enumerate(times) if i == 0 or best[key, t] != best[key, times[i - 1]]]
        for i, t in enumerate(kept):
            value = [v if known else None for known, v in best[key, t]]
            out.append((key, *value, t, kept[i + 1] if i + 1 < len(kept) else None))
    return sorted(out, key=repr)


def as_rows(history) -> list[tuple]:
    columns = ["vendor_id", "vendor_name", "status", "dbt_valid_from", "dbt_valid_to"]
    return sorted((tuple(r) for r in history.select(*columns).collect()), key=repr)


def random_changes(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["A", "B"]), rng.choice(["x", "y", None]),
         T1 + timedelta(days=rng.randrange(120), hours=rng.choice([0, 12])))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_history_of_changes_equals_brute_force(changes, seed):
    rows = random_changes(150, seed)
    assert as_rows(history_of_changes(changes(*rows), "vendor_id", TRACKED, "at")) == by_hand(rows)


def test_late_change_between_two_equal_observations(changes):
    rows = [(1, "A", "x", T1), (1, "A", "x", T3), (1, "A", "y", T2)]
    assert as_rows(history_of_changes(changes(*rows), "vendor_id", TRACKED, "at")) == [
        (1, "A", "x", T1, T2), (1, "A", "x", T3, None), (1, "A", "y", T2, T3)
    ]


def test_history_of_no_changes_and_of_a_change_without_time(changes):
    assert history_of_changes(changes(), "vendor_id", TRACKED, "at").count() == 0
    with pytest.raises(Exception, match="a change without at"):
        history_of_changes(changes((1, "A", "x", None)), "vendor_id", TRACKED, "at").collect()


def test_batches_in_any_order_give_one_history(spark, changes, tmp_path):
    rows = random_changes(40, 9)
    batches = [rows[:15], rows[15:25], rows[25:]]
    for i, order in enumerate(permutations(range(3))):
        if i % 2:
            continue
        paths = [str(tmp_path / f"{name}{i}") for name in ("observations", "history")]
        for b in (*order, order[0]):
            refresh_changes(spark, changes(*batches[b]), *paths, "vendor_id", TRACKED, "at", buckets=2)
        stored = read_table(spark, paths[1], history_schema(VENDORS))
        assert as_rows(stored) == by_hand(rows)


def test_untouched_key_buckets_keep_their_files(spark, changes, tmp_path):
    paths = [str(tmp_path / name) for name in ("observations", "history")]
    refresh_changes(spark, changes(*[(k, "A", "x", T1) for k in range(20)]), *paths, "vendor_id", TRACKED, "at", 8)
    files = lambda: set(read_table(spark, paths[1], history_schema(VENDORS)).inputFiles())
    before = files()
    refresh_changes(spark, changes((3, "A", "y", T2)), *paths, "vendor_id", TRACKED, "at", 8)
    kept = before & files()
    assert kept and len({f.split("/")[-2] for f in before - kept}) == 1


def test_whole_changes_are_shuffled_once(spark, changes):
    """Then come the months only, one row each: their exchanges are by key, and back by group."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = changes(*random_changes(20, 1))
        plan = plan_text(ordered_changes(rows, "vendor_id", TRACKED, "at", F.col("status") == "x"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    whole = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert ["ReusedExchange" in line for line in whole] == [False, True]


def test_a_batch_without_news_rewrites_no_history_and_a_broken_refresh_is_mended(spark, changes, tmp_path, monkeypatch):
    paths = [str(tmp_path / name) for name in ("observations", "history")]
    rows = [(k, "A", "x", T1) for k in range(12)]
    refresh_changes(spark, changes(*rows), *paths, "vendor_id", TRACKED, "at", 4)
    files = lambda: set(read_table(spark, paths[1], history_schema(VENDORS)).inputFiles())
    before = files()
    assert refresh_changes(spark, changes(*rows[:5]), *paths, "vendor_id", TRACKED, "at", 4) == 0
    assert files() == before

    late = (3, "A", "y", T2)
    with monkeypatch.context() as broken:
        broken.setattr(trip_build, "history_of_ordered", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_changes(spark, changes(late), *paths, "vendor_id", TRACKED, "at", 4)
    refresh_changes(spark, changes(rows[7]), *paths, "vendor_id", TRACKED, "at", 4)
    assert as_rows(read_table(spark, paths[1], history_schema(VENDORS))) == by_hand([*rows, late])


# ---------------------------------------------------------------- facts at their version


def test_versions_of_keys_without_facts_are_not_laid_into_days(spark, changes, trips_at, monkeypatch):
    copies = {}
    keep = history_module.written_copy
    monkeypatch.setattr(history_module, "written_copy", lambda df, label: copies.setdefault(label, keep(df, label)))
    rows = [(k, "A", "x", T1) for k in range(1, 40)]
    history = history_of_changes(changes(*rows), "vendor_id", TRACKED, "at")
    trips = [(1, 1, T1, "own"), (2, 1, T1 + timedelta(days=9), "own"), (3, 2, T1, "own")]
    assert at_version(trips_at(*trips), history, "vendor_id", "at", ["status"]).count() == 3
    assert copies["versions-of-facts"].count() == 10 + 1


@pytest.fixture
def trips_at(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "trip int, vendor_id int, at timestamp_ntz, status string")


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_facts_at_their_version(changes, trips_at, bucket):
    rows = [r for r in random_changes(60, 4) if r[0] is not None]
    history = history_of_changes(changes(*rows), "vendor_id", TRACKED, "at")
    trips = [
        (i, (1, 2, 3, 4, None)[i % 5], T1 + timedelta(hours=12 * (i * 7 % 300) - 24), "own") for i in range(200)
    ] + [(200, 1, None, "own")]
    got = {r["trip"]: r for r in at_version(trips_at(*trips), history, "vendor_id", "at", ["status"], bucket).collect()}
    assert len(got) == len(trips)
    versions = by_hand(rows)
    for trip, vendor, at, status in trips:
        valid = [
            (v[2], v[3]) for v in versions
            if at is not None and v[0] == vendor and v[3] <= at and (v[4] is None or at < v[4])
        ]
        assert [(got[trip]["version_status"], got[trip]["version_from"])] == (valid or [(None, None)])
        assert got[trip]["status"] == status


def test_facts_at_version_join_by_key_and_bucket(changes, trips_at):
    history = history_of_changes(changes((1, "A", "x", T1)), "vendor_id", TRACKED, "at")
    plan = plan_text(at_version(trips_at((1, 1, T2, "own")), history, "vendor_id", "at", ["status"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_facts_and_no_versions(changes, trips_at):
    history = history_of_changes(changes(), "vendor_id", TRACKED, "at")
    assert at_version(trips_at(), history, "vendor_id", "at", ["status"]).count() == 0
    some = at_version(trips_at((1, 1, T2, "own")), history, "vendor_id", "at", ["status"])
    assert some.first()["version_from"] is None
    with pytest.raises(ValueError, match="bucket"):
        at_version(trips_at(), history, "vendor_id", "at", ["status"], "week")
