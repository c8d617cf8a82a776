"""Rows in which two tables differ, found by checksums of days, hours and key buckets.

A leaf of the tree is a bucket of keys within an hour; its checksum is a count and sums of row hashes, so it
does not depend on the order of rows and merges by adding up. Only the leaves that differ are opened,
and only the partitions that hold them are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.sinks.tables import written_copy
from tripmill.sinks.upsert import touched_partitions

BUCKETS = 64
# Differing leaves up to this number are broadcast.
MAX_BROADCAST_LEAVES = 100_000
LEAF = ["leaf_day", "leaf_hour", "leaf_bucket"]


def _leaf(key: Sequence[str], time_column: str, buckets: int) -> list[Column]:
    at = F.col(time_column)
    # NULL parts are hashed as such
    parts = [p for k in key for p in (F.col(k), F.col(k).isNull())]
    return [
        F.to_date(at).alias("leaf_day"),
        F.hour(at).alias("leaf_hour"),
        F.pmod(F.xxhash64(*parts), F.lit(buckets)).alias("leaf_bucket"),
    ]


def checksums(
    df: DataFrame,
    key: Sequence[str],
    time_column: str,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Count and four sums of row hashes of each leaf; leaves of parts of a table add up.

    A leaf is a bucket within an hour, and within a partition if ``partition_by`` names the columns.
    """
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in range(2)]
    halves = [h for x in hashes for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(0xFFFFFFFF))]
    return (
        df.select(*partition_by, *_leaf(key, time_column, buckets), *[h.alias(f"h{i}") for i, h in enumerate(halves)])
        .groupBy(*partition_by, *LEAF)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"h{i}").alias(f"h{i}") for i in range(4)])
    )


def differing_leaves(source: DataFrame, target: DataFrame) -> DataFrame:
    """Leaves whose checksums differ, one that a side lacks among them."""
    figures = ["n", "h0", "h1", "h2", "h3"]
    leaf = [c for c in source.columns if c not in figures]
    negated = target.select(*leaf, *[(-F.col(f)).alias(f) for f in figures])
    summed = source.unionByName(negated).groupBy(*leaf).agg(*[F.sum(f).alias(f) for f in figures])
    return summed.where(" OR ".join(f"{f} <> 0" for f in figures)).select(*leaf)


def row_drift(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    time_column: str,
    partition_by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows that only one side holds, or holds more often: side, copies and all columns of ``source``.

    ``copies`` counts the rows that the side has more than the other. Both sides have the same
    columns. ``partition_by`` names the partition columns of the stored tables: then only partitions
    with differing leaves are read the second time. A row without a time is compared like any other.
    """
    columns = source.columns
    sides = [source, target.select(*columns)]
    sums = [checksums(s, key, time_column, columns, partition_by, buckets) for s in sides]
    leaves = written_copy(differing_leaves(*sums), "drift-leaves")
    few = leaves.count() <= MAX_BROADCAST_LEAVES
    named = leaves.select(*LEAF).distinct().select(*[F.col(c).alias(f"_{c}") for c in LEAF])
    opened = []
    for sign, side in zip((1, -1), sides, strict=True):
        if partition_by:
            side = touched_partitions(side, leaves, partition_by)
        leaf = dict(zip(LEAF, _leaf(key, time_column, buckets), strict=True))
        marked = side.withColumns({f"_l_{c}": e for c, e in leaf.items()})
        same = [F.col(f"_l_{c}").eqNullSafe(F.col(f"_{c}")) for c in LEAF]
        marked = marked.join(F.broadcast(named) if few else named, same[0] & same[1] & same[2], "left_semi")
        opened.append(marked.select(*columns, F.lit(sign).alias("_sign")))
    summed = opened[0].unionByName(opened[1]).groupBy(*columns).agg(F.sum("_sign").alias("_sign"))
    return summed.where("_sign <> 0").select(
        F.when(F.col("_sign") > 0, "source").otherwise("target").alias("side"),
        F.abs("_sign").alias("copies"),
        *columns,
    )
