"""Full refresh, views, schema sync and written copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.session import scratch_path


def materialize_table(df: DataFrame, path: str) -> None:
    """Full refresh. ``path`` must not be read by ``df`` itself."""
    df.write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Live view: every query through it recomputes from the source."""
    df.createOrReplaceTempView(name)
    return df


def sync_schema(existing: DataFrame, schema: T.StructType) -> DataFrame:
    """Give stored rows the columns of an incoming schema.

    New columns are NULL in old rows, columns that are gone are dropped.
    """
    have = set(existing.columns)
    return existing.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def written_copy(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of a frame that several jobs will read.

    The rows go to the shared scratch folder as Parquet: unlike cached blocks
    they survive lost executors, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
