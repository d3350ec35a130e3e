"""Guarded arithmetic.  ANSI mode (the Spark 4 default) raises on x/0, so
every division is behind an explicit guard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, when_zero: float = 0.0) -> Column:
    """``CASE WHEN coalesce(d,0) = 0 THEN when_zero ELSE coalesce(n,0)/d END`` as double."""
    d = F.coalesce(denominator, F.lit(0))
    return F.when(d == 0, F.lit(when_zero)).otherwise(
        F.coalesce(numerator, F.lit(0)).cast("double") / denominator.cast("double")
    )


def relative_change(current: Column, previous: Column) -> Column:
    """``(current - previous) / previous`` when previous > 0, else 0."""
    return F.when(F.coalesce(previous, F.lit(0)) > 0, (current - previous) / previous).otherwise(F.lit(0.0))


def exact_avg(c: Column) -> Column:
    """Average of an exact (decimal / integer) column as double: the sum stays
    exact and a single division rounds it, so the result does not depend on
    the order rows were added in.  Null when there is no non-null value."""
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)
