import datetime as dt

from pyspark.sql import functions as F

from attrition.functions import calendar_months, months_30day, parse_date, relative_change, safe_ratio

D = dt.date.fromisoformat


def _age_months(a: dt.date, b: dt.date) -> int:
    """Whole calendar months from a to b: (dy*12 + dm) minus one if b's day is not reached."""
    m = (b.year - a.year) * 12 + (b.month - a.month)
    return m - 1 if b.day < a.day else m


def test_month_end_pairs(spark):
    pairs = [("2024-01-31", "2024-02-29", 0), ("2024-02-29", "2024-12-31", 10), ("2021-07-15", "2024-12-31", 41),
             ("2022-05-31", "2024-12-31", 31), ("2020-02-29", "2024-12-31", 58), ("2019-01-01", "2024-12-31", 71)]
    df = spark.createDataFrame([(D(a), D(b)) for a, b, _ in pairs], "a date, b date")
    got = [r[0] for r in df.select(calendar_months(F.col("a"), F.col("b"))).collect()]
    assert got == [m for _, _, m in pairs]


def test_calendar_months_random_pairs(spark):
    import random
    rnd = random.Random(7)
    base = D("2020-01-01")
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(days=rnd.randint(0, 1500))
        b = a + dt.timedelta(days=rnd.randint(0, 1500))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(calendar_months(F.col("a"), F.col("b"))).collect()]
    assert got == [_age_months(a, b) for a, b in pairs]


def test_days30_clip(spark):
    df = spark.createDataFrame([(D("2025-01-01"),), (D("2019-01-01"),)], "d date")
    got = [r[0] for r in df.select(months_30day(F.col("d"), D("2024-12-31"))).collect()]
    assert got == [0, 73]


def test_guards(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, None)], "n long, d long")
    got = [r[0] for r in df.select(safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [0.0, 0.25, 0.0]
    df = spark.createDataFrame([(6.0, 0.0), (50.0, 100.0)], "a double, b double")
    assert [r[0] for r in df.select(relative_change(F.col("a"), F.col("b"))).collect()] == [0.0, -0.5]


def test_parse_date(spark):
    df = spark.createDataFrame([("2024-02-29",), ("bad",)], "s string")
    got = [r[0] for r in df.select(parse_date(F.col("s"), strict=False)).collect()]
    assert got == [D("2024-02-29"), None]
