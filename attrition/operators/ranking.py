"""Exact positions in an order, within groups, without a per-group task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a
group to one task; with no ``PARTITION BY`` it sends the whole table to one
task.  ``ordered_position`` computes the same numbers with the group split
over as many tasks as its size needs:

1. range-partition and sort on ``(g, o)``: the sampled range bounds cut a
   large group into several partitions;
2. tag each row with its partition (``_pid``) and its running id in that
   partition (``monotonically_increasing_id`` counts rows in sorted order);
   the tagged rows are checkpointed into the shared checkpoint folder so the
   tags are stable across the two uses below;
3. count rows per (group, partition) -- one row per group per partition it
   touches -- and turn the counts into offsets with a window over the
   partitions of a group (at most the partition count per group);
4. position = offset of (group, partition) + distance from the first row of
   the group in that partition.

The join in step 4 is on (group, partition), so a group split over several
partitions is also several join keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.session import cut_lineage


def ordered_position(df: DataFrame, order: list, group: list[str] | None = None,
                     name: str = "position", group_size: str | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order`` within ``group``.

    ``order`` entries may be column names or sort Columns (``F.col(c).desc()``).
    ``group_size`` optionally adds the size of the row's group.  Rows equal on
    every group and order column are interchangeable.
    """
    g = list(group or [])
    keys = [F.col(c) for c in g] + [F.col(o) if isinstance(o, str) else o for o in order]
    tagged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = cut_lineage(tagged)
    per = tagged.groupBy(*g, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    parts = Window.partitionBy(*g).orderBy("_pid")
    cols = [*g, "_pid", "_first",
            F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")]
    if group_size:
        cols.append(F.sum("_n").over(Window.partitionBy(*g)).alias(group_size))
    offsets = per.select(*cols)
    if not g:
        # one row per partition: bounded by the partition count
        offsets = F.broadcast(offsets)
    # null groups are groups like any other, so the keys compare null-safe
    renamed = offsets.withColumnsRenamed({c: f"_{c}_key" for c in [*g, "_pid"]})
    same = tagged["_pid"] == renamed["__pid_key"]
    for c in g:
        same &= tagged[c].eqNullSafe(renamed[f"_{c}_key"])
    joined = tagged.join(renamed, same).drop(*[f"_{c}_key" for c in [*g, "_pid"]])
    return joined.withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first")).drop(
        "_pid", "_mid", "_first", "_off")
