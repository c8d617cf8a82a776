from __future__ import annotations

from datetime import datetime

from conftest import same_rows

from tripmill.operators.quality import dq_issue_summary, quality_filter, quarantine

GOOD = {}
NEGATIVE_FARE = {"fare_amount": -1.0}
NO_PASSENGERS_KNOWN = {"passenger_count": None}
SEVEN = {"passenger_count": 7}
BACKWARDS_AND_FREE = {
    "total_amount": 0.0,
    "dropoff_datetime": datetime(2024, 1, 5, 8, 0),
}


def reasons(df) -> list[list[str]]:
    return sorted(row["dq_failure_reasons"] for row in df.collect())


def test_clean_rows_satisfy_every_rule(staged):
    rows = staged(GOOD, {"fare_amount": 0.0}, NEGATIVE_FARE, NO_PASSENGERS_KNOWN, SEVEN)
    assert quality_filter(rows).count() == 2


def test_reasons_are_listed_in_rule_order(staged):
    rows = staged(GOOD, SEVEN, BACKWARDS_AND_FREE)
    assert reasons(quarantine(rows)) == [
        ["INVALID_PASSENGER_COUNT"],
        ["NON_POSITIVE_FARE", "INVALID_DATETIME_ORDER"],
    ]


def test_negative_fares_and_nulls_are_in_neither_table(staged):
    rows = staged(NEGATIVE_FARE, NO_PASSENGERS_KNOWN)
    assert quality_filter(rows).count() == 0
    assert quarantine(rows).count() == 0


def test_complete_quarantine_is_the_rest_of_the_input(staged):
    rows = staged(GOOD, NEGATIVE_FARE, NO_PASSENGERS_KNOWN, SEVEN, BACKWARDS_AND_FREE)
    broken = quarantine(rows, complete=True)
    both = quality_filter(rows).unionByName(broken.drop("dq_failure_reasons"))
    assert same_rows(rows, both)
    assert ["NEGATIVE_FARE"] in reasons(broken)
    assert ["NULL_PASSENGER_COUNT"] in reasons(broken)


def test_summary_counts_a_row_once_per_reason(staged):
    rows = staged(SEVEN, BACKWARDS_AND_FREE, {**SEVEN, "ingestion_ts": datetime(2024, 2, 2, 9)})
    summary = dq_issue_summary(quarantine(rows)).collect()
    assert [(str(r["load_date"]), r["failure_reason"], r["trip_count"]) for r in summary] == [
        ("2024-02-02", "INVALID_PASSENGER_COUNT", 1),
        ("2024-02-01", "INVALID_DATETIME_ORDER", 1),
        ("2024-02-01", "INVALID_PASSENGER_COUNT", 1),
        ("2024-02-01", "NON_POSITIVE_FARE", 1),
    ]
