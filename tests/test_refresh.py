"""Monthly state: appended months equal a full recompute, and only new partitions are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attrition.operators.windows import month_end_windows, reporting_windows
from attrition.plans import refresh
from attrition.plans.features_asof import THEMES, features_asof
from attrition.sources import store
from attrition.sources.files import shared_dir
from attrition.sources.testtables import load_tables

D = dt.date


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def saved(spark):
    tables = load_tables(spark, "/root/testdata/sf0.001")
    small = {k: tables[k].filter(F.col(store.PARTITION_BY[k]).between(D(1999, 10, 1), D(2000, 3, 31)))
             if store.PARTITION_BY[k] else tables[k] for k in store.PARTITION_BY}
    loc = store.save_tables(small, shared_dir(spark, "store"))
    return store.load_tables(spark, loc, {k: v.schema for k, v in small.items()})


@pytest.fixture(scope="module")
def state(spark, saved):
    path = shared_dir(spark, "state")
    refresh.update_months(saved, path, D(1999, 10, 1), D(2000, 1, 31))
    for _ in range(2):      # a repeated run changes nothing
        refresh.update_months(saved, path, D(2000, 2, 1), D(2000, 2, 29))
    refresh.update_months(saved, path, D(2000, 3, 1), D(2000, 3, 31))
    return refresh.load_state(spark, path)


def test_appended_months_equal_a_full_recompute(spark, saved, state):
    path = shared_dir(spark, "state")
    refresh.update_months(saved, path, D(1999, 10, 1), D(2000, 3, 31))
    for name, whole in refresh.load_state(spark, path).items():
        assert _rows(state[name].select(*whole.columns)) == _rows(whole)
    windows = month_end_windows(spark, D(2000, 3, 31), 4, months=3)
    assert _rows(refresh.features_from_state(state, saved, windows)) == _rows(features_asof(saved, windows))


def test_only_new_partitions_are_read(saved, long_plans):
    for name, theme in THEMES.items():
        plan = refresh.month_sums(saved, name, D(2000, 3, 1), D(2000, 3, 31))._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull({theme.date}" in plan and "2000-03-01" in plan and "2000-03-31" in plan
        assert plan.count("FileScan") == 1 and "Python" not in plan


def test_features_read_the_windows_months_only(spark, saved, state, long_plans):
    windows = reporting_windows(spark, [(0, D(2000, 2, 1), D(2000, 3, 31))])
    plan = refresh.features_from_state(state, saved, windows)._jdf.queryExecution().executedPlan().toString()
    low, high = 2000 * 12 + 2, 2000 * 12 + 3
    assert plan.count("PartitionFilters: [isnotnull(segment") == 3
    assert plan.count(f">= {low}") >= 3 and plan.count(f"<= {high}") >= 3
    assert "montant" not in plan


def test_parts_of_months_are_refused(spark, saved, state):
    with pytest.raises(ValueError, match="whole months"):
        refresh.update_months(saved, "unused", D(2000, 2, 1), D(2000, 2, 28))
    with pytest.raises(Exception, match="whole months"):
        refresh.features_from_state(state, saved, reporting_windows(spark, [(0, D(2000, 2, 2), D(2000, 3, 31))])).collect()
