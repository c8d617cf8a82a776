"""Keyed upsert into a partitioned Parquet table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.bitmaps import BITS_A_BITMAP, BITS_A_KEY, key_bitmaps, marked
from tripmill.operators.dedup import keep_latest, latest_first
from tripmill.sinks.landing import LandingPlan, land
from tripmill.sinks.tables import written_copy
from tripmill.sources.files import path_exists
from tripmill.sources.tables import read_table

# Up to this many touched partitions become literals that prune the scan of the
# stored table; beyond it they stay a table and are joined.
MAX_LITERAL_PARTITIONS = 4096

# Hashes of repeated keys are broadcast up to this number (16 MB of them); beyond it a bitmap of them is.
MAX_BROADCAST_HASHES = 2_000_000

# Size of that bitmap at most. With more keys than it has room for, more single rows pass as repeated.
MAX_BITMAP_BYTES = 32 << 20

# With more files than that a partition, stored rows are gathered into new files as well.
MAX_FILES_A_PARTITION = 8


def _any_of(rows: list, columns: Sequence[str]) -> Column:
    """``(a = 1 AND b IN (...)) OR (a = 2 AND b IN (...))`` over partition values."""
    *outer, last = columns
    groups: dict[tuple, list] = defaultdict(list)
    for row in rows:
        groups[tuple(row[c] for c in outer)].append(row[last])
    branches = []
    for values, lasts in groups.items():
        known = [v for v in lasts if v is not None]
        branch = F.col(last).isin(*known) if known else F.lit(False)
        if len(known) < len(lasts):
            branch = branch | F.col(last).isNull()
        for column, value in zip(outer, values, strict=True):
            branch = branch & (F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
        branches.append(branch)
    return reduce(lambda a, b: a | b, branches)


def touched_partitions(
    stored: DataFrame, incoming: DataFrame, partition_by: Sequence[str]
) -> DataFrame:
    """Stored rows of the partitions that incoming rows belong to."""
    touched = incoming.select(*partition_by).distinct()
    few = touched.limit(MAX_LITERAL_PARTITIONS + 1).collect()
    if not few:
        return stored.limit(0)
    if len(few) <= MAX_LITERAL_PARTITIONS:
        return stored.where(_any_of(few, partition_by))
    named = touched.select(*[F.col(c).alias(f"_touched_{c}") for c in partition_by])
    same = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by]
    return stored.join(named, reduce(lambda a, b: a & b, same), "left_semi")


def _splitter(frames: Sequence[DataFrame], key: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Splits rows into those whose key is single in ``frames`` and those whose key may be there twice.

    The latter have all repeated keys, and few others. No row is shuffled for it, however many keys repeat.
    """
    hashes = reduce(DataFrame.unionAll, [df.select(F.xxhash64(key).alias("_hash")) for df in frames])
    counted = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    repeated = written_copy(counted.where("_rows > 1").select("_hash"), "upsert-hashes")
    n = repeated.count()
    if n <= MAX_BROADCAST_HASHES:
        same = F.xxhash64(key) == F.col("_hash")
        return lambda df: tuple(df.join(F.broadcast(repeated), same, how) for how in ("left_anti", "left_semi"))
    bits = min(-(-n * BITS_A_KEY // BITS_A_BITMAP), MAX_BITMAP_BYTES * 8 // BITS_A_BITMAP) * BITS_A_BITMAP
    bitmaps = written_copy(key_bitmaps(repeated, F.col("_hash"), bits), "upsert-bitmaps")

    def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = marked(df, F.xxhash64(key), bitmaps, bits)
        return rows.where("NOT _marked").drop("_marked"), rows.where("_marked").drop("_marked")

    return split


def _in_few_files(table: DataFrame) -> bool:
    files = table.inputFiles()
    return len(files) <= MAX_FILES_A_PARTITION * len({f.rsplit("/", 1)[0] for f in files})


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: str,
    partition_by: Sequence[str],
    resolve: str = "incoming",
    order: Sequence[str] = (),
    plan: LandingPlan | None = None,
    stable: bool = False,
    gathered: bool = False,
) -> int:
    """Insert new keys, replace known ones; returns the rows of rewritten partitions.

    The partition columns must be functions of the key, so a key never moves
    between partitions and only touched partitions are read and rewritten.
    A NULL partition value is a partition like any other. ``resolve="incoming"``
    lets the new row win; ``resolve="latest"`` ranks stored and incoming rows by
    ``order``. If ``incoming`` holds a key more than once, the first by ``order``,
    then by all columns, descending, is taken, on the first load as well.
    One writer at a time: plain Parquet folders give no isolation.

    Hashes of all keys are shuffled, and whole rows only of the batch and where a key may be there twice.
    Other stored rows of a touched partition are written by the tasks that read them. ``stable`` says that
    ``incoming`` is read from files that stay as they are, so that no copy of it is needed; ``plan`` is for the batch.
    ``gathered`` says that a partition's rows lie together in those files: new rows are written where they are read, too.
    """
    if resolve not in ("incoming", "latest"):
        raise ValueError(f"unknown resolve mode {resolve!r}")
    if resolve == "latest" and not order:
        raise ValueError("resolve='latest' needs an order")
    ranked = latest_first(incoming, [key], order)
    # read several times below: for its partitions, its keys and its rows
    batch = incoming if stable else written_copy(incoming, "upsert")
    if not path_exists(spark, path):
        single, several = _splitter([batch], key)(batch)
        latest = keep_latest(several, [key], ranked)
        if gathered:
            return land(latest, path, partition_by, plan, settled=single)
        return land(single.unionByName(latest), path, partition_by, plan)

    # the declared schema also adds new columns as NULL and drops removed ones
    table = read_table(spark, path, incoming.schema)
    stored = touched_partitions(table, batch, partition_by)
    # only rows whose key may be there twice are shuffled to be compared; hashes decide nothing else
    split = _splitter([stored, batch], key)
    (settled, known), (new, several) = split(stored), split(batch)
    if resolve == "latest":
        merged = keep_latest(known.unionByName(several), [key], order)
    else:
        latest = keep_latest(several, [key], ranked)
        merged = known.join(several.select(key), key, "left_anti").unionByName(latest)
    # what is written where it is read, and what is brought together by partition
    where_read, fresh = ([new], [merged]) if gathered else ([], [new, merged])
    (where_read if _in_few_files(table) else fresh).insert(0, settled)
    fresh, where_read = (reduce(DataFrame.unionByName, rows) if rows else None for rows in (fresh, where_read))
    return land(fresh, path, partition_by, plan, settled=where_read)
