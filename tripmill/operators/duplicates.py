"""Report of trips that were submitted more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import minute_boundaries
from tripmill.functions.keys import TRIP_KEY
from tripmill.operators.bitmaps import BITS_A_BITMAP, BITS_A_KEY, key_bitmaps, marked
from tripmill.sinks.tables import written_copy

# Copies of the statistics, and parts a group of submissions is cut into.
SALTS = 8

# What submissions of one trip differ in. Few columns on purpose: the optimizer
# rewrites the salt for every combination of equal columns it finds.
SALT_COLUMNS = ("dropoff_datetime", "total_amount", "trip_distance", "ingestion_ts")


def submission_statistics(staged: DataFrame, keys: Sequence[str] = TRIP_KEY) -> DataFrame:
    """Counts and ranges of each group with more than one submission."""
    known = [F.col(k).isNotNull() for k in keys]
    for condition in known:
        staged = staged.where(condition)
    return (
        staged.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("submission_count"),
            F.min("dropoff_datetime").alias("earliest_dropoff"),
            F.max("dropoff_datetime").alias("latest_dropoff"),
            F.min("total_amount").alias("min_fare"),
            F.max("total_amount").alias("max_fare"),
            F.min("trip_distance").alias("min_distance"),
            F.max("trip_distance").alias("max_distance"),
            F.min("ingestion_ts").alias("first_seen"),
            F.max("ingestion_ts").alias("last_seen"),
        )
        .where("submission_count > 1")
    )


# Size of the bitmap beyond which there is none.
MAX_BITMAP_BYTES = 32 << 20


def maybe_repeated(staged: DataFrame, statistics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The trips whose key may be in ``statistics``: all of those, and few others.

    The bitmap has 16 bits for each repeated key and is broadcast up to 32 MiB; beyond that all trips
    are kept, and the join drops those that are single.
    """
    bits = max(1, -(-statistics.count() * BITS_A_KEY // BITS_A_BITMAP)) * BITS_A_BITMAP
    if bits // 8 > MAX_BITMAP_BYTES:
        return staged
    bitmaps = key_bitmaps(statistics, F.xxhash64(*keys), bits)
    return marked(staged, F.xxhash64(*keys), bitmaps, bits, "inner").where("_marked").select(*staged.columns)


def duplicate_report(
    staged: DataFrame, keys: Sequence[str] = TRIP_KEY, salts: int = SALTS
) -> DataFrame:
    """Every submission of a duplicated trip with the statistics of its group.

    A key with a NULL part matches nothing. The statistics are aggregated
    before their shuffle, stored, and are few. Trips whose key is not among them are dropped by
    a bitmap of key hashes before anything wide is shuffled. The others meet them by key and salt: the
    salt, a hash of what submissions differ in, spreads one group over several
    tasks, and the shuffle on both sides lets AQE split further what hashes
    alike. A hash gives the same salt when a lost task is run again.
    """
    statistics = written_copy(submission_statistics(staged, keys), "repeated-keys")
    salted_statistics = statistics.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    salt = F.pmod(F.xxhash64(*SALT_COLUMNS), F.lit(salts)).cast("int")
    salted_trips = maybe_repeated(staged, statistics, keys).withColumn("_salt", salt)
    flagged = salted_trips.join(salted_statistics, [*keys, "_salt"], "inner")
    return flagged.select(
        *staged.columns,
        *[c for c in salted_statistics.columns if c not in (*keys, "_salt")],
        (F.col("max_fare") - F.col("min_fare")).alias("fare_variance"),
        (F.col("max_distance") - F.col("min_distance")).alias("distance_variance"),
        minute_boundaries(F.col("earliest_dropoff"), F.col("latest_dropoff")).alias(
            "dropoff_variance_minutes"
        ),
    )
