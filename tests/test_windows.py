"""Features for a relation of windows: equal to one build per window, every fact read once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attrition.operators.windows import (month_end_windows, reporting_windows, segment_windows, segments, to_windows,
                                         with_segment)
from attrition.plans.features import build_features
from attrition.plans.features_asof import features_asof
from attrition.sources import store
from attrition.sources.files import shared_dir
from attrition.sources.testtables import load_tables

SF = "/root/testdata/sf0.001"
D = dt.date


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def saved(spark):
    tables = load_tables(spark, SF)
    dates = {"abonnements": "date_debut", "facturation": "date_facture", "interactions_support": "date_interaction",
             "usage_mensuel": "mois"}
    # a few months of each fact keep the number of date folders small
    small = {k: tables[k].filter(F.col(dates[k]).between(D(1999, 10, 1), D(2000, 3, 31))) if k in dates else tables[k]
             for k in store.PARTITION_BY}
    loc = store.save_tables(small, shared_dir(spark, "store"))
    return store.load_tables(spark, loc, {k: v.schema for k, v in small.items()})


def test_month_ends(spark):
    got = [tuple(r) for r in month_end_windows(spark, D(2000, 3, 15), 3).collect()]
    assert got == [(0, D(1999, 2, 1), D(2000, 1, 31)), (1, D(1999, 3, 1), D(2000, 2, 29)), (2, D(1999, 4, 1), D(2000, 3, 31))]


def test_segments_cover_each_window_once(spark):
    windows = [(1, D(2000, 1, 1), D(2000, 1, 31)), (2, D(2000, 1, 15), D(2000, 2, 10)), (3, D(2000, 5, 5), D(2000, 5, 5)),
               (4, D(2000, 1, 1), D(2000, 1, 31)), (5, D(1999, 12, 20), D(2000, 6, 1))]
    relation = reporting_windows(spark, windows)
    pieces = segments(relation)
    days = spark.sql("SELECT explode(sequence(DATE'1999-12-01', DATE'2000-06-30')) AS d, 7L AS client_id")
    placed = with_segment(days, "d", pieces)
    got = {(r.window_id, r.d) for r in to_windows(placed, segment_windows(relation, pieces)).collect()}
    want = {(w, r.d) for w, a, b in windows for r in days.collect() if a <= r.d <= b}
    assert got == want
    assert placed.groupBy("d").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("windows", [
    [(3, D(1999, 11, 1), D(2000, 2, 29)), (1, D(2000, 1, 1), D(2000, 1, 31)), (9, D(1999, 10, 5), D(2000, 3, 20)),
     (2, D(2000, 1, 10), D(2000, 1, 31)), (4, D(1980, 1, 1), D(1980, 12, 31))]])
def test_equal_to_one_build_per_window(spark, saved, windows):
    got = features_asof(saved, reporting_windows(spark, windows))
    want = []
    for number, start, ref in windows:
        one = build_features(saved, ref, start)
        want += [(number, ref, *r) for r in _rows(one)]
    assert _rows(got) == sorted(want, key=repr) and len(want) > 100


def test_every_fact_is_scanned_once(spark, saved):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features_asof(saved, month_end_windows(spark, D(2000, 3, 31), 12))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") == 6      # the six tables, once each
    for column in ("montant", "theme", "nb_connexions", "date_fin"):
        assert len([x for x in plan.splitlines() if "FileScan parquet" in x and column in x]) == 1, column
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan
    assert "_salt" in plan and "partial_sum" in plan


def test_no_windows_no_rows(spark, saved):
    assert features_asof(saved, reporting_windows(spark, [])).count() == 0
