"""Date expressions (JVM-side, whole-stage codegen; no Python UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    """A column for a column, a literal for a date / string / number."""
    return value if isinstance(value, Column) else F.lit(value)


def calendar_months(start, end) -> Column:
    """Whole calendar months from ``start`` to ``end``, as int.

    Same as years*12 + months of the interval between the two dates: a month
    counts once the day of month is reached (2024-01-31 -> 2024-02-29 is 0,
    2024-02-29 -> 2024-12-31 is 10).  ``timestampdiff(MONTH, ...)`` has this
    rule; ``months_between`` does not (it treats two month ends as a whole
    month).
    """
    return F.timestamp_diff("MONTH", as_col(start), as_col(end)).cast("int")


def months_30day(start, end) -> Column:
    """Elapsed days floor-divided by 30, clipped at 0 (script variant)."""
    days = F.datediff(as_col(end), as_col(start))
    return F.greatest(F.lit(0), F.floor(days / 30).cast("int"))


def parse_date(text, fmt: str = "yyyy-MM-dd", strict: bool = True) -> Column:
    """ISO string -> date.  ``strict`` raises on bad input (ANSI); otherwise null."""
    c = as_col(text)
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)


def in_period(c: Column, start: dt.date, end: dt.date) -> Column:
    """Closed interval on a DATE column (BETWEEN); both bounds reach the scan."""
    return c.between(F.lit(start), F.lit(end))
