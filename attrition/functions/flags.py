"""0/1 flags and set membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(predicate: Column) -> Column:
    """``CASE WHEN p THEN 1 ELSE 0 END`` (null -> 0, three-valued logic)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def membership_flag(df: DataFrame, ids: DataFrame, key: str, name: str = "in_set") -> DataFrame:
    """Add ``name`` = 1 when ``df[key]`` is in ``ids[key]``, else 0.

    A left join against the distinct id set, never a driver-side list.  The
    id set is not broadcast by hint: it can grow with the data, so the join
    strategy is left to the optimizer's size check (AQE broadcasts it when
    it is small at runtime, a sort-merge join otherwise).  ``distinct`` is a
    partial aggregate, so a repeated hot id collapses map-side.
    """
    hits = ids.select(key).distinct().withColumn("__hit", F.lit(1))
    return df.join(hits, key, "left").withColumn(name, F.coalesce(F.col("__hit"), F.lit(0))).drop("__hit")
