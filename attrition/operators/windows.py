"""A relation of reporting windows joined to facts by binned intervals.

The starts and ends of all windows cut time into segments: every date lies in one segment, and a window is a run of
consecutive ones.  A fact meets its segment through the months the segment touches (an equality
join, the dates compare after it), is summed by (client, segment) before anything else,
and only these sums go to the windows that hold the segment.  So a fact is read and moved once, however many
windows overlap it, and there is neither a cross nor a nested-loop join.

Month keys are few, so both sides carry a salt from the client: where the windows are too many for a
broadcast, a month's facts are still dealt to ``SALTS`` tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SALTS = 64
WINDOWS = "window_id bigint, start date, ref date"


def reporting_windows(spark: SparkSession, windows: Iterable[tuple[int, dt.date, dt.date]]) -> DataFrame:
    """The relation (window_id, start, ref); both dates belong to the window."""
    return spark.createDataFrame(list(windows), WINDOWS)


def month_end_windows(spark: SparkSession, last: dt.date, n: int, months: int = 12) -> DataFrame:
    """``n`` windows of ``months`` whole months, the last one ending with the month of ``last``; ids 0 .. n - 1, oldest first."""
    first = last.year * 12 + last.month - n     # month number (from 0) of the oldest window's end

    def day(month: int) -> dt.date:
        return dt.date(month // 12, month % 12 + 1, 1)

    return reporting_windows(spark, [(k, day(first + k - months + 1), day(first + k + 1) - dt.timedelta(days=1)) for k in range(n)])


def segments(windows: DataFrame) -> DataFrame:
    """segment (from 0), first, last: the pieces into which all windows' bounds cut the time they cover.

    Sized by the windows, not by the facts (at most two segments for each window).
    """
    bounds = windows.select(F.explode(F.array("start", F.date_add("ref", 1))).alias("first")).distinct()
    order = Window.orderBy("first")
    pieces = bounds.select((F.row_number().over(order) - 1).cast("long").alias("segment"), "first",
                           F.date_sub(F.lead("first").over(order), 1).alias("last"))
    return pieces.filter(F.col("last").isNotNull())


def segment_windows(windows: DataFrame, pieces: DataFrame) -> DataFrame:
    """segment, window_id: the segments of each window, by the number of its first and last one."""
    first = windows.join(pieces.select(F.col("first").alias("start"), F.col("segment").alias("_from")), "start")
    both = first.join(pieces.select(F.col("last").alias("ref"), F.col("segment").alias("_to")), "ref")
    return both.select(F.explode(F.sequence("_from", "_to")).alias("segment"), "window_id")


def _month(date: Column) -> Column:
    return (F.year(date) * 12 + F.month(date)).cast("int")


def _salt(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def with_segment(facts: DataFrame, date: str, pieces: DataFrame, key: str = "client_id") -> DataFrame:
    """``facts`` inside the windows' time with their ``segment``: one row each."""
    binned = _salted(pieces.withColumn("_month", F.explode(F.sequence(_month(F.col("first")), _month(F.col("last"))))))
    return (facts.withColumns({"_month": _month(F.col(date)), "_salt": _salt(key)}).join(binned, ["_month", "_salt"])
            .filter(F.col(date).between(F.col("first"), F.col("last"))).drop("_month", "_salt", "first", "last"))


def to_windows(sums: DataFrame, members: DataFrame, key: str = "client_id") -> DataFrame:
    """Rows by (``key``, segment) once for every window that holds the segment: ``segment`` becomes ``window_id``."""
    return (sums.withColumn("_salt", _salt(key)).join(_salted(members), ["segment", "_salt"])
            .drop("segment", "_salt"))
