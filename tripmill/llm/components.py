"""Connected components by alternating large and small stars.

Every step is a join-free aggregation over edges, stored in the shared folder, so lineage stays
short and a lost executor costs a step at most. A hub's neighbours are spread by their own key:
only minima travel, and they are combined before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v's."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node with an edge in ``edges`` (a, b); the least node names it.

    Loops and repeated edges do no harm; an empty table gives an empty one.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "large-star")
        # towards smaller neighbours only, and each node to its least as well
        small = _with_least(large)
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        now = stored(small, "small-star")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
