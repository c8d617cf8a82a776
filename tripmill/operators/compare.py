"""Source-to-target comparison of grouped metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is one SQL expression for both sides, or one per side.
KeySpec = Mapping[str, str | tuple[str, str]]

DEFAULT_TOLERANCE = 1e-9


def _side(df: DataFrame, keys: KeySpec, metrics: Mapping[str, str], position: int) -> DataFrame:
    grouping = [
        F.expr(k if isinstance(k, str) else k[position]).alias(name) for name, k in keys.items()
    ]
    return df.groupBy(*grouping).agg(*[F.expr(m).alias(name) for name, m in metrics.items()])


def _agree(source: Column, target: Column, kind: T.DataType, tolerance: float) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        scale = F.greatest(F.abs(source), F.abs(target), F.lit(1.0))
        close = F.abs(source - target) <= scale * F.lit(tolerance)
        return F.coalesce(close, source.isNull() & target.isNull())
    return source.eqNullSafe(target)


def compare_metrics(
    source: DataFrame,
    target: DataFrame,
    keys: KeySpec | None = None,
    metrics: Mapping[str, str] | None = None,
    tolerance: float = DEFAULT_TOLERANCE,
) -> DataFrame:
    """Both sides' metrics per key with delta and verdict.

    Keys may be derived differently on the two sides, such as a folder's month
    against the month of the event. A key that one side lacks stays in the
    result with NULL there. Both sides are aggregated first; their small
    results are then brought together by one more aggregation, which also
    matches NULL keys and needs no join when there are no keys. A side has one row
    for each key, so two rows are both sides.
    """
    keys = dict(keys or {})
    metrics = dict(metrics or {"row_count": "count(*)"})
    left = _side(source, keys, metrics, 0)
    right = _side(target, keys, metrics, 1)
    kinds = {f.name: f.dataType for f in left.schema.fields}

    def tagged(side: DataFrame, filled: str, empty: str) -> DataFrame:
        return side.select(
            *keys,
            *[F.col(m).alias(f"{filled}_{m}") for m in metrics],
            *[F.lit(None).cast(kinds[m]).alias(f"{empty}_{m}") for m in metrics],
            F.lit(filled).alias("_side"),
        )

    both = tagged(left, "source", "target").unionByName(tagged(right, "target", "source"))
    paired = both.groupBy(*keys).agg(
        *[F.max(f"{side}_{m}").alias(f"{side}_{m}") for m in metrics for side in ("source", "target")],
        F.count(F.lit(1)).alias("_sides"),
    )
    columns: list[Column] = []
    verdicts: list[Column] = []
    for m in metrics:
        s, t = F.col(f"source_{m}"), F.col(f"target_{m}")
        columns += [s, t]
        if isinstance(kinds[m], T.NumericType):
            columns.append((t - s).alias(f"delta_{m}"))
        verdicts.append(_agree(s, t, kinds[m], tolerance))
    matches = F.col("_sides") == 2
    for verdict in verdicts:
        matches = matches & verdict
    return paired.select(*keys, *columns, matches.alias("matches"))
