"""Quality rules: the clean rows, the quarantined rows and their summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row is clean if ``holds`` is true and broken if ``fails`` is true.

    With a NULL operand neither is true. ``reported`` rules put a broken row
    into quarantine; the others only keep it out of the clean rows.
    """

    code: str
    holds: str
    fails: str
    operands: tuple[str, ...]
    reported: bool = True


# The trip rules and their reason codes.
TRIP_RULES: tuple[Rule, ...] = (
    Rule("NON_POSITIVE_FARE", "total_amount > 0", "total_amount <= 0", ("total_amount",)),
    Rule("NON_POSITIVE_DISTANCE", "trip_distance > 0", "trip_distance <= 0", ("trip_distance",)),
    Rule(
        "INVALID_DATETIME_ORDER",
        "pickup_datetime < dropoff_datetime",
        "pickup_datetime >= dropoff_datetime",
        ("pickup_datetime", "dropoff_datetime"),
    ),
    Rule(
        "INVALID_PASSENGER_COUNT",
        "passenger_count BETWEEN 1 AND 6",
        "passenger_count NOT BETWEEN 1 AND 6",
        ("passenger_count",),
    ),
    Rule("NEGATIVE_FARE", "fare_amount >= 0", "fare_amount < 0", ("fare_amount",), reported=False),
)


def quality_filter(df: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """Rows for which every rule is known to hold."""
    return df.where(" AND ".join(f"({r.holds})" for r in rules))


def _breaches(rules: Sequence[Rule], complete: bool) -> list[tuple[str, Column]]:
    found = [(r.code, F.expr(r.fails)) for r in rules if r.reported or complete]
    if complete:
        operands = dict.fromkeys(c for r in rules for c in r.operands)
        found += [(f"NULL_{c.upper()}", F.col(c).isNull()) for c in operands]
    return found


def quarantine(
    df: DataFrame, rules: Sequence[Rule] = TRIP_RULES, complete: bool = False
) -> DataFrame:
    """Rows that break a rule, with the list of reasons.

    By default a negative fare or a NULL operand is no reason, so such rows are
    neither clean nor quarantined. ``complete=True`` reports them too: then
    every row is in exactly one of the two.
    """
    found = _breaches(rules, complete)
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(code)) for code, broken in found]))
    any_broken = reduce(lambda a, b: a | b, [broken for _, broken in found])
    return df.where(any_broken).withColumn("dq_failure_reasons", reasons)


def explode_reasons(quarantined: DataFrame) -> DataFrame:
    """One row per quarantined trip and reason, with the day it was loaded."""
    return quarantined.select(
        "vendor_id",
        "cab_type",
        "pickup_datetime",
        "dropoff_datetime",
        "total_amount",
        "ingestion_ts",
        F.to_date("ingestion_ts").alias("load_date"),
        F.explode("dq_failure_reasons").alias("failure_reason"),
    )


def dq_issue_summary(quarantined: DataFrame) -> DataFrame:
    """Volume, amount and time span of each reason per load day."""
    return (
        explode_reasons(quarantined)
        .groupBy("load_date", "failure_reason")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.sum("total_amount").alias("total_amount_flagged"),
            F.min("pickup_datetime").alias("first_seen_issue_at"),
            F.max("pickup_datetime").alias("last_seen_issue_at"),
        )
        .orderBy(F.col("load_date").desc(), "failure_reason")
    )
