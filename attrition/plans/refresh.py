"""Features kept up to date month by month.

The state holds, for every client and month, the sums of each theme (the same as
:mod:`attrition.plans.features_asof` makes by segment, a segment being a month).  A new month reads its own date
partitions of the facts and replaces its own partition of the state, so a run that is repeated changes nothing;
features for any windows of whole months are then made from the state, without the facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.plans.features_asof import THEMES, assembled
from attrition.session import cut_lineage


def month_number(date: Column) -> Column:
    return (F.year(date) * 12 + F.month(date)).cast("long")


def month_sums(tables: Mapping[str, DataFrame], name: str, first: dt.date, last: dt.date) -> DataFrame:
    """Sums by (client, month) of the facts of one theme from ``first`` to ``last``."""
    theme = THEMES[name]
    date = F.col(theme.date)
    rows = tables[theme.table].filter(date.between(F.lit(first), F.lit(last))).select(*theme.columns)
    return theme.sums(rows.withColumn("segment", month_number(date)))


def update_months(tables: Mapping[str, DataFrame], path: str, first: dt.date, last: dt.date) -> None:
    """Make the state of the months from ``first`` (a first of a month) to ``last`` (a last of a month) anew."""
    if first.day != 1 or (last + dt.timedelta(days=1)).day != 1 or last < first:
        raise ValueError(f"{first} to {last} are not whole months")
    for name in THEMES:
        (month_sums(tables, name, first, last).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("segment").parquet(f"{path}/{name}"))


def load_state(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}").withColumn("segment", F.col("segment").cast("long")) for name in THEMES}


def features_from_state(state: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], windows: DataFrame) -> DataFrame:
    """As :func:`~attrition.plans.features_asof.features_asof`, for windows of whole months, from the state.

    A month that was never made counts as one without facts.
    """
    whole = (F.dayofmonth("start") == 1) & (F.dayofmonth(F.date_add("ref", 1)) == 1)
    windows = cut_lineage(windows.select("window_id", F.when(whole, F.col("start")).otherwise(
        F.raise_error(F.lit("a window of the state must be whole months")).cast("date")).alias("start"), "ref"))
    months = F.sequence(month_number(F.col("start")), month_number(F.col("ref")))
    members = cut_lineage(windows.select(F.explode(months).alias("segment"), "window_id"))
    low, high = members.agg(F.min("segment"), F.max("segment")).first()     # two numbers, for partition pruning
    held = {name: df.filter(F.col("segment").between(F.lit(low), F.lit(high))) for name, df in state.items()}
    return assembled(tables, windows, members, held)
