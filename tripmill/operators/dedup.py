"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_first(df: DataFrame, key: Sequence[str], leading: Sequence[str]) -> list[str]:
    """``leading`` columns, then every other column, so that no tie is left open."""
    rest = [c for c in df.columns if c not in set(leading) | set(key)]
    return [*leading, *rest]


def keep_latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first when sorted by ``order``, descending, NULLs last.

    ``row_number() = 1`` makes Catalyst keep one row per key and task before the
    shuffle as well, so a key with very many copies does not overload a task.
    """
    ranked = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
