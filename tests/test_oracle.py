"""Every registered query against its DuckDB text on the smallest test tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        p = f"{SF}/{v}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return [(0, "") if v is None else (1, str(v)) for v in row]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    want = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 24
