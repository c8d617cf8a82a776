"""Row history with validity intervals (slowly changing dimensions)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import snapshot_id, truncate, utc_now
from tripmill.schemas import struct
from tripmill.sinks.tables import written_copy

# The history columns added to the tracked row.
HISTORY_COLUMNS = ("dbt_scd_id", "dbt_valid_from", "dbt_valid_to", "dbt_updated_at")


def history_schema(source: T.StructType) -> T.StructType:
    added = struct(
        dbt_scd_id="string",
        dbt_valid_from="timestamp_ntz",
        dbt_valid_to="timestamp_ntz",
        dbt_updated_at="timestamp_ntz",
    )
    return T.StructType(source.fields + added.fields)


def _moment(now: datetime | str | None) -> Column:
    value = utc_now() if now is None else F.lit(str(now))
    return value.cast("timestamp_ntz")


def open_versions(rows: DataFrame, key: str, now: datetime | str | None = None) -> DataFrame:
    """First version of every row."""
    at = _moment(now)
    return rows.withColumns(
        {
            "dbt_scd_id": snapshot_id(F.col(key), at),
            "dbt_valid_from": at,
            "dbt_valid_to": F.lit(None).cast("timestamp_ntz"),
            "dbt_updated_at": at,
        }
    )


def scd2_check(
    history: DataFrame | None,
    incoming: DataFrame,
    key: str,
    check_columns: Sequence[str],
    now: datetime | str | None = None,
) -> DataFrame:
    """Complete history after comparing the open versions with incoming rows.

    New keys open a version. A change in any check column (NULL-safe) closes the
    open version and opens another. Unchanged keys, and keys that are missing
    from the input, keep their open version. ``incoming`` holds each key once.
    """
    if history is None:
        return open_versions(incoming, key, now)
    tracked = incoming.columns
    every = [*tracked, *HISTORY_COLUMNS]
    closed = history.where(F.col("dbt_valid_to").isNotNull()).select(*every)
    current = history.where(F.col("dbt_valid_to").isNull())
    at = _moment(now)

    old = current.select(F.col(key).alias("_key"), F.struct(*every).alias("_old"))
    new = open_versions(incoming, key, now).select(
        F.col(key).alias("_key"), F.struct(*every).alias("_new")
    )
    same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_columns]
    unchanged = same[0]
    for condition in same[1:]:
        unchanged = unchanged & condition
    keep_old = F.array("_old")
    replace = F.array(F.col("_old").withField("dbt_valid_to", at), F.col("_new"))
    versions = (
        F.when(F.col("_new").isNull(), keep_old)
        .when(F.col("_old").isNull(), F.array("_new"))
        .when(unchanged, keep_old)
        .otherwise(replace)
    )
    live = (
        old.join(new, "_key", "full_outer")
        .select(F.explode(versions).alias("_version"))
        .select("_version.*")
    )
    return closed.unionByName(live)


def ordered_changes(
    changes: DataFrame, key: str, tracked: Sequence[str], at: str, known: Column | None = None
) -> DataFrame:
    """One row for each key and moment of ``changes``: ``key``, ``tracked``, ``at``, and what becomes of it.

    ``opens_version`` tells if it differs from the observation before it; ``version_to`` is when the next
    one opens; ``is_news`` if the rows that are ``known`` already do not hold it alike. Whole rows are shuffled once, by key and month, so a key with very many changes is spread
    over as many tasks as it has months. The months of a key, one row each, then tell what comes before and after.
    """
    moment = F.coalesce(F.col(at), F.raise_error(F.lit(f"a change without {at}")).cast("timestamp_ntz"))
    # a struct is never NULL, so all steps below meet by one column, also where the key is NULL
    group = F.struct(F.col(key).alias("key"), truncate(moment, "month").alias("month"))
    old = F.lit(False) if known is None else known
    rows = (
        changes.select(group.alias("_group"), moment.alias("_at"), F.struct(*tracked).alias("_row"), old.alias("_old"))
        .repartition("_group")
        .groupBy("_group", "_at")
        .agg(F.max("_row").alias("_row"), F.max(F.when(F.col("_old"), F.col("_row"))).alias("_old"))
        .withColumn("_news", ~F.col("_row").eqNullSafe(F.col("_old"))).drop("_old")
    )
    before = F.lag("_row").over(Window.partitionBy("_group").orderBy("_at"))
    # open for the first row of a month, which its month cannot tell
    rows = rows.withColumn("_opens", F.when(before.isNotNull(), ~F.col("_row").eqNullSafe(before))).withColumn(
        "_next", F.expr("lead(IF(_opens, _at, NULL)) IGNORE NULLS OVER (PARTITION BY _group ORDER BY _at)")
    )
    months = rows.groupBy("_group").agg(
        F.min("_at").alias("_first_at"),
        F.min_by("_row", "_at").alias("_first"),
        F.max_by("_row", "_at").alias("_last"),
        F.max(F.when(F.col("_opens").isNull(), F.col("_next"))).alias("_later"),
        F.max("_news").alias("_month_news"),
    ).withColumns({"_key": F.col("_group")["key"], "_month": F.col("_group")["month"]})
    last = F.lag("_last").over(Window.partitionBy("_key").orderBy("_month"))
    edges = months.withColumn("_edge_opens", ~F.col("_first").eqNullSafe(last)).withColumn(
        "_opening", F.when(F.col("_edge_opens"), F.col("_first_at")).otherwise(F.col("_later"))
    ).select(
        F.col("_group").alias("_edge_group"),
        "_edge_opens",
        "_month_news",
        F.expr("lead(_opening) IGNORE NULLS OVER (PARTITION BY _key ORDER BY _month)").alias("_following"),
    )
    return rows.join(edges, F.col("_group") == F.col("_edge_group")).select(
        F.col("_group")["key"].alias(key),
        *[F.col("_row")[c].alias(c) for c in tracked],
        F.col("_at").alias(at),
        F.coalesce("_opens", "_edge_opens").alias("opens_version"),
        F.coalesce("_next", "_following").alias("version_to"),
        # rows and months read the same columns, so that Spark shuffles them once for both
        (F.col("_news") & F.col("_month_news")).alias("is_news"),
    )


def history_of_ordered(ordered: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """History from the result of :func:`ordered_changes`, row by row."""
    return ordered.where("opens_version").select(
        key,
        *tracked,
        snapshot_id(F.col(key), F.col(at)).alias("dbt_scd_id"),
        F.col(at).alias("dbt_valid_from"),
        F.col("version_to").alias("dbt_valid_to"),
        F.col(at).alias("dbt_updated_at"),
    )


def history_of_changes(changes: DataFrame, key: str, tracked: Sequence[str], at: str) -> DataFrame:
    """History from all observations of rows: ``key``, ``tracked`` columns, and ``at``, when they held.

    The order of the rows does not matter. An observation equal to the one before it in time opens no
    version. Of several at one moment the greatest in order of ``tracked`` counts (NULL is least). A
    NULL key is a key like any other; an observation without a time is an error.
    """
    return history_of_ordered(ordered_changes(changes, key, tracked, at), key, tracked, at)


# Widths of the buckets in which facts and versions meet.
VERSION_BUCKETS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH"}


def at_version(
    facts: DataFrame, history: DataFrame, key: str, at: str, columns: Sequence[str], bucket: str = "day"
) -> DataFrame:
    """``facts`` with the ``columns`` of the version that was valid at ``at``, and its ``version_from``.

    A version is laid into each day (or month) that it covers within the time of its key's facts, so both meet
    by key and bucket: an equi-join, which Spark broadcasts by measured size or shuffles, splitting hot
    pairs. Keys without facts are left out first. Facts are written once, as they are read twice. ``version_*`` columns are NULL where no version was valid, or key or time is NULL. Versions
    of a key must not overlap, as histories here never do. Buckets should be about as long as versions last.
    """
    if bucket not in VERSION_BUCKETS:
        raise ValueError(f"unknown bucket {bucket!r}")
    names = {c: f"version_{c}" for c in columns}
    facts = written_copy(facts, "facts-at-version")
    spans = written_copy(
        facts.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        .groupBy(F.col(key).alias("_span_key")).agg(F.min(at).alias("_low"), F.max(at).alias("_high")),
        "facts-at-version-spans",
    )
    start, end, low, high = (F.col(c) for c in ("dbt_valid_from", "dbt_valid_to", "_low", "_high"))
    # only versions of keys that have facts, within the time of those
    wanted = (F.col(key) == F.col("_span_key")) & (start <= high) & (end.isNull() | ((end > low) & (end > start)))
    covered = F.sequence(
        truncate(F.greatest(start, low), bucket).cast("date"),
        truncate(F.least(F.coalesce(end, high), high), bucket).cast("date"),
        F.expr(VERSION_BUCKETS[bucket]),
    )
    versions = written_copy(
        history.join(spans, wanted).select(
            F.col(key).alias("_version_key"),
            start.alias("version_from"),
            end.alias("_version_to"),
            *[F.col(c).alias(n) for c, n in names.items()],
            F.explode(covered).alias("_version_bucket"),
        ),
        "versions-of-facts",
    )
    valid = (
        (F.col(key) == F.col("_version_key"))
        & (truncate(F.col(at), bucket).cast("date") == F.col("_version_bucket"))
        & (F.col("version_from") <= F.col(at))
        & (F.col("_version_to").isNull() | (F.col(at) < F.col("_version_to")))
    )
    return facts.join(versions, valid, "left").select(*[facts[c] for c in facts.columns], "version_from", *names.values())


def dim_current(history: DataFrame) -> DataFrame:
    """Open versions with plain names for the validity columns."""
    return _renamed(history.where(F.col("dbt_valid_to").isNull()))


def dim_as_of(history: DataFrame, moment: datetime | str) -> DataFrame:
    """The versions that were valid at a moment."""
    at = _moment(moment)
    valid = (F.col("dbt_valid_from") <= at) & (
        F.col("dbt_valid_to").isNull() | (at < F.col("dbt_valid_to"))
    )
    return _renamed(history.where(valid))


def _renamed(history: DataFrame) -> DataFrame:
    tracked = [c for c in history.columns if c not in HISTORY_COLUMNS]
    return history.select(
        *tracked,
        F.col("dbt_valid_from").alias("valid_from"),
        F.col("dbt_updated_at").alias("last_updated"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )
