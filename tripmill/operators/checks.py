"""Data-quality assertions as table operators.

Every ``failing_*`` function gives the violating rows or values, distributed.
:func:`run_checks` gives the number of failures of many checks as one table.
Only ``not_null`` looks at NULLs; the other checks ignore them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import utc_now


@dataclass(frozen=True)
class Check:
    """One assertion about one column (or, for ``unique``, several)."""

    kind: str
    column: str
    values: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    strict: bool = False
    parent: str | None = None
    parent_column: str | None = None
    max_age: timedelta | None = None

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in self.column.split(",")]


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def unique(*columns: str) -> Check:
    return Check("unique", ", ".join(columns))


def in_set(column: str, values: Sequence) -> Check:
    return Check("in_set", column, values=tuple(values))


def between(
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    strict: bool = False,
) -> Check:
    return Check("between", column, minimum=minimum, maximum=maximum, strict=strict)


def relationship(column: str, parent: str, parent_column: str) -> Check:
    return Check("relationship", column, parent=parent, parent_column=parent_column)


def freshness(column: str, max_age: timedelta) -> Check:
    """Fails if the last arrival is older, or there is none."""
    return Check("freshness", column, max_age=max_age)


def _outside(check: Check) -> Column:
    value = F.col(check.column)
    sides = []
    if check.minimum is not None:
        sides.append(value <= check.minimum if check.strict else value < check.minimum)
    if check.maximum is not None:
        sides.append(value >= check.maximum if check.strict else value > check.maximum)
    if not sides:
        raise ValueError("a between check needs a minimum or a maximum")
    return reduce(lambda a, b: a | b, sides)


def violation(check: Check) -> Column:
    """Predicate that is true for the rows a row-level check rejects."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "in_set":
        return ~F.col(check.column).isin(*check.values)
    if check.kind == "between":
        return _outside(check)
    raise ValueError(f"{check.kind} is not a row-level check")


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(violation(Check("not_null", column)))


def failing_in_set(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(violation(in_set(column, values)))


def failing_between(
    df: DataFrame,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    strict: bool = False,
) -> DataFrame:
    return df.where(violation(between(column, minimum, maximum, strict)))


def failing_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def failing_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child values without a parent, with their number of rows.

    The child is counted per value before it meets the parent, so the join sees
    each value once however often it occurs.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def _result(model: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    )


def row_level_results(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of a model in a single pass over it."""
    counts = df.agg(*[F.count_if(violation(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    results = F.array(*[_result(model, c, F.col(f"c{i}")) for i, c in enumerate(checks)])
    return counts.select(F.inline(results))


def _text(columns: Sequence[Column], kinds: Sequence[T.DataType]) -> Column:
    """Values as one text that is equal only where all of them are."""
    texts = []
    for value, kind in zip(columns, kinds, strict=True):
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0)  # both zeros are one value
        texts.append(value.cast("string"))
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)])


def run_checks(
    frames: Mapping[str, DataFrame],
    suites: Mapping[str, Sequence[Check]],
    now: datetime | None = None,
) -> DataFrame:
    """Model, check, column and number of failures for every check of a suite.

    A row gives an entry (check, value) for each check that it concerns: its value for
    ``unique`` and ``relationship``, none where a row-level check rejects it. Parents give their
    values as well. One aggregation of all entries answers all checks, so each model is scanned
    once and there is one shuffle of values; entries are pre-aggregated before it, so a
    hot value is a row a task. ``now`` is the moment that ``freshness`` looks from.
    """
    moment = (utc_now() if now is None else F.lit(str(now))).cast("timestamp_ntz")
    nothing = F.lit(None)

    def entry(check: int, value: Column | None = None, child: int = 1, arrival: Column | None = None) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            (nothing if value is None else value).cast("string").alias("value"),
            F.lit(child).cast("bigint").alias("child"),
            F.lit(1 - child).alias("parent"),
            (nothing if arrival is None else arrival).cast("timestamp_ntz").alias("arrival"),
        )

    known: list[tuple[str, Check]] = []
    parts: list[DataFrame] = []
    for model, checks in suites.items():
        df = frames[model]
        entries = []
        for check in checks:
            number = len(known)
            known.append((model, check))
            own = [F.col(c) for c in check.columns]
            full = reduce(lambda a, b: a & b, [c.isNotNull() for c in own])
            kinds = [df.schema[c].dataType for c in check.columns]
            if check.kind == "unique":
                entries.append(F.when(full, entry(number, _text(own, kinds))))
            elif check.kind == "relationship":
                parent = frames[check.parent]
                kind = parent.schema[check.parent_column].dataType
                floats = any(isinstance(k, (T.DoubleType, T.FloatType)) for k in (kind, *kinds))
                common = T.DoubleType() if floats else T.StringType()
                entries.append(F.when(full, entry(number, _text([own[0].cast(common)], [common]))))
                theirs = F.col(check.parent_column)
                parts.append(
                    parent.where(theirs.isNotNull())
                    .select(entry(number, _text([theirs.cast(common)], [common]), child=0).alias("e"))
                    .select("e.*")
                )
            elif check.kind == "freshness":
                entries.append(F.when(full, entry(number, arrival=own[0])))
            else:
                entries.append(F.when(violation(check), entry(number)))
        parts.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    values = reduce(DataFrame.unionByName, parts).groupBy("check", "value").agg(
        F.sum("child").alias("child"), F.max("parent").alias("parent"), F.max("arrival").alias("arrival")
    )
    figures = values.groupBy("check").agg(
        F.sum("child").alias("rows"),
        F.count_if(F.col("child") > 1).alias("repeated"),
        F.sum(F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).alias("orphans"),
        F.max("arrival").alias("arrival"),
    )
    # one row that holds the figures of all checks, those without an entry are missing
    everything = figures.agg(
        F.map_from_entries(F.collect_list(F.struct("check", F.struct("rows", "repeated", "orphans", "arrival")))).alias("m")
    )

    def failures(number: int, check: Check) -> Column:
        figure = F.try_element_at("m", F.lit(number))
        if check.kind == "freshness":
            minutes = F.timestamp_diff("MINUTE", figure["arrival"], moment)
            late = minutes > check.max_age.total_seconds() / 60
            return F.when(F.coalesce(late, F.lit(True)), 1).otherwise(0)
        name = {"unique": "repeated", "relationship": "orphans"}.get(check.kind, "rows")
        return F.coalesce(figure[name], F.lit(0))

    results = [_result(model, check, failures(i, check)) for i, (model, check) in enumerate(known)]
    return everything.select(F.inline(F.array(*results)))


def check_not_null(df: DataFrame, columns: Sequence[str], model: str = "table") -> DataFrame:
    return row_level_results(model, df, not_null(*columns))


def check_unique(df: DataFrame, columns: Sequence[str], model: str = "table") -> DataFrame:
    return run_checks({model: df}, {model: [unique(*columns)]})


def check_in_set(df: DataFrame, column: str, values: Sequence, model: str = "table") -> DataFrame:
    return row_level_results(model, df, [in_set(column, values)])


def check_between(
    df: DataFrame,
    column: str,
    minimum: float | None = None,
    maximum: float | None = None,
    strict: bool = False,
    model: str = "table",
) -> DataFrame:
    return row_level_results(model, df, [between(column, minimum, maximum, strict)])


def check_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    frames = {"child": child, "parent": parent}
    return run_checks(frames, {"child": [relationship(column, "parent", parent_column)]})


def check_freshness(
    df: DataFrame,
    column: str = "ingestion_ts",
    warn_after: timedelta | None = None,
    error_after: timedelta | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Age of the last arrival in whole minutes and its status.

    Without a limit the matching status is never given; an empty table has no
    age and is an error.
    """
    moment = utc_now() if now is None else F.lit(str(now))
    latest = df.agg(F.max(column).cast("timestamp_ntz").alias("latest_arrival")).withColumn(
        "_now", moment.cast("timestamp_ntz")
    )
    age = F.timestamp_diff("MINUTE", F.col("latest_arrival"), F.col("_now"))
    status = F.when(F.col("latest_arrival").isNull(), "error")
    for name, limit in (("error", error_after), ("warn", warn_after)):
        if limit is not None:
            minutes = limit.total_seconds() / 60
            status = status.when(F.col("age_minutes") > minutes, name)
    return (
        latest.withColumn("age_minutes", age)
        .withColumn("status", status.otherwise("pass"))
        .select("latest_arrival", "age_minutes", "status")
    )
