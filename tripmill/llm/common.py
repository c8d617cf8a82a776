"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import scratch_path

MAX_BROADCAST_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # where all characters are ASCII, lower() does the same without a look-up for each of them
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


#: Fixed value of the contract: what stands between words, after A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Array of lower-case words; null text has none."""
    parts = F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN, -1)
    return F.filter(parts, lambda w: w != "")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_broadcast(df: DataFrame, row_bytes: int, rows: int) -> DataFrame:
    """Hint a broadcast only when the measured size is small; a shuffled join otherwise."""
    return F.broadcast(df) if rows * row_bytes <= MAX_BROADCAST_BYTES else df


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row, whatever later filters and columns read it.

    A plain projection may be merged into each expression above it; a generator is not.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


#: Of a join's other side, at most this many keys are hot, as each holds more than this part of all rows.
HOT_KEYS = 4096


def skewed_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int, how: str = "inner") -> DataFrame:
    """``left`` with the row of ``right`` for its key, however many rows of ``left`` share a key.

    Keys of ``right`` are unique; its column ``rows`` (dropped) counts the rows of ``left`` that hold the
    key, ``total`` counts all of them. Keys that hold over a 4096th of all are 4096 at most, so these
    are broadcast; the others meet in a shuffled join. ``how`` may be "left". Both sides should be stored.
    """
    limit = max(total // HOT_KEYS, 16)
    hot = right.where(F.col(rows) > limit).drop(rows)
    cold = right.where(F.col(rows) <= limit).drop(rows)
    rest = left.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return left.join(F.broadcast(hot), on).unionByName(rest.join(cold, on, how))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that what is derived from their texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    # else Arrow keeps what is free now, and it stays with the worker while it waits for other stages' tasks
    pa.default_memory_pool().release_unused()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever the driver was started.

    ``spark-submit --py-files`` does the same; a session that was started without it gets the
    package's source files as a zip, once an application.
    """
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    name = f"{package.name}-package.zip"
    if any(str(f).endswith(name) for f in context.listFiles):
        return
    path = Path(tempfile.mkdtemp(prefix="package-")) / name
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
