"""Connected components of a distributed edge list (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges``: a, b (bigint).  One row per node that has an edge to another: id and the
    smallest id of its component.

    Every round keeps the edge list linear in the nodes' links; edges of a hub
    meet one row (its smallest neighbour), so a hub is no unbounded group.
    """
    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    def smallest(e: DataFrame) -> DataFrame:
        # written, so that the join reads two plain shuffles and a hub can be split
        return stored(e.groupBy("a").agg(F.min("b").alias("m")), "least")

    current = stored(down(edges), "edges")
    seen = mark(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = smallest(both)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        large = stored(down(large), "edges")
        least = smallest(large)
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                                 F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = stored(down(small.select("e.*")), "edges")
        now = mark(current)
        if now == seen:
            break
        seen = now
    members = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("id"), "component").distinct())
