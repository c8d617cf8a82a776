from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import values

from tripmill.operators.ledger import (
    append_ledger,
    classify_volume,
    expand_slices,
    ledger_rows,
    ledger_state,
    pending_slices,
    read_ledger,
    reconcile,
    record_landed,
    reset_slices,
    slice_gaps,
    slice_status,
)
from tripmill.plans.backfill import new_batch_id
from tripmill.schemas import LEDGER, SLICE_REQUESTS

EARLY, LATE = datetime(2024, 2, 1), datetime(2024, 2, 2)


@pytest.fixture
def requests(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SLICE_REQUESTS)


@pytest.fixture
def ledger(spark):
    rows = [
        ("green#2024_01_01", "b1", "FAILED", "spark", EARLY),
        ("green#2024_01_01", "b2", "LANDED", "spark", LATE),
        ("green#2024_01_02", "b1", "LANDED", "spark", EARLY),
        ("green#2024_01_02", "b2", "FAILED", "spark", LATE),
        ("green#2024_01_05", "b1", "LANDED", "spark", EARLY),
    ]
    return spark.createDataFrame(rows, LEDGER)


@pytest.mark.parametrize(
    ("year", "month", "day", "count"),
    [
        ("2024", None, None, 366),
        ("2023", None, None, 365),
        ("2024", "02", None, 29),
        ("2023", "2", None, 28),
        ("2024", "12", "31", 1),
        ("2024", "none", None, 366),
    ],
)
def test_expansion(requests, year, month, day, count):
    keys = expand_slices(requests(("Green", year, month, day)))
    assert keys.count() == count


def test_keys_are_distinct_and_padded(requests):
    keys = expand_slices(requests(("green", "2024", "1", None), ("green", "2024", "01", "05")))
    assert keys.count() == 31
    assert values(keys, "slice_id")[0] == "green#2024_01_01"


def test_a_day_needs_a_month(requests):
    with pytest.raises(Exception, match="a day needs a month"):
        expand_slices(requests(("green", "2024", None, "05"))).collect()


def test_latest_row_is_the_status(ledger):
    state = {r["slice_id"]: r["status"] for r in ledger_state(ledger).collect()}
    assert state["green#2024_01_01"] == "LANDED"
    assert state["green#2024_01_02"] == "FAILED"


def test_pending_days_are_those_not_landed(requests, ledger):
    keys = expand_slices(requests(("green", "2024", "01", None)))
    pending = values(pending_slices(keys, ledger), "slice_id")
    assert len(pending) == 29
    assert "green#2024_01_02" in pending


def test_recording_and_resetting(requests, ledger):
    keys = pending_slices(expand_slices(requests(("green", "2024", "01", None))), ledger)
    done = record_landed(ledger, keys, "b3", "spark", datetime(2024, 2, 3))
    assert values(done, "status") == ["LANDED"] * 31
    reset = reset_slices(done, requests(("green", "2024", "01", "01")), at=datetime(2024, 2, 4))
    assert reset.where("status = 'PENDING'").count() == 1
    assert reset.count() == 31


def test_append_and_read(spark, requests, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).count() == 0
    keys = expand_slices(requests(("green", "2024", "01", "01")))
    for _ in range(2):
        append_ledger(ledger_rows(keys, "LANDED", "b1", "spark", EARLY), path)
    assert ledger_state(read_ledger(spark, path)).count() == 1


def test_status_and_gaps(requests, ledger):
    january = requests(("green", "2024", "01", None))
    assert slice_status(ledger, january).count() == 31
    gaps = sorted(
        (r["status"], r["gap_start"].day, r["gap_end"].day, r["days"])
        for r in slice_gaps(ledger, january).collect()
    )
    assert gaps == [("FAILED", 2, 2, 1), ("MISSING", 3, 4, 2), ("MISSING", 6, 31, 26)]


def test_drift_in_both_directions(spark, ledger):
    days = spark.createDataFrame(
        [("green", date(2024, 1, 1)), ("green", date(2024, 1, 9))], "cab_type string, day date"
    )
    drift = {r["slice_id"]: r["drift"] for r in reconcile(ledger, days).collect()}
    assert drift == {
        "green#2024_01_05": "LANDED_WITHOUT_DATA",
        "green#2024_01_09": "DATA_WITHOUT_LEDGER",
    }


def test_volume_classes(spark):
    volumes = spark.createDataFrame([(0,), (1,), (1 << 30,), (None,)], "bytes bigint")
    assert values(classify_volume(volumes), "volume_class") == ["empty", "empty", "high", "low"]


def test_batch_id():
    parts = new_batch_id("spark", "green", "2024", "6", None).split("#")
    assert parts[:3] == ["spark", "green", "2024_06_ALL"]
    assert len(parts[3]) == 8
