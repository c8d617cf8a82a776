"""Bitmaps of key hashes: small enough to broadcast, they tell which rows may have one of many keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits for each key, and of one bitmap of 4 KiB.
BITS_A_KEY = 16
BITS_A_BITMAP = 8 * 4096


def _place(hashes: Column, bits: int) -> Column:
    return F.pmod(hashes, F.lit(bits)) + 1


def key_bitmaps(keys: DataFrame, hashes: Column, bits: int) -> DataFrame:
    """(_bucket, _bitmap): a bit for the hash of each key, in bitmaps of 4 KiB."""
    place = _place(hashes, bits)
    return (
        keys.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    )


def marked(df: DataFrame, hashes: Column, bitmaps: DataFrame, bits: int, how: str = "left") -> DataFrame:
    """``df`` with ``_marked``: true for all rows with one of the keys and for few others, never null.

    ``how="inner"`` may leave out rows that are not marked.
    """
    place = _place(hashes, bits)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    # bound before the join, so that the hash is made once a row
    bucketed = df.withColumn("_bucket", F.bitmap_bucket_number(place))
    return bucketed.join(F.broadcast(bitmaps), "_bucket", how).select(*[df[c] for c in df.columns], is_set.alias("_marked"))
