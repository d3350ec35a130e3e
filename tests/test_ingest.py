"""Checks while writing: every row once, reasons and counts equal to the separate checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators import ingest, quality
from attrition.sources.files import shared_dir
from attrition.sources.schema import contracts

D = dt.date(2024, 1, 1)
CONTRACT = contracts(T.LongType())["facturation"]
SCHEMA = "facture_id bigint, client_id bigint, date_facture date, montant decimal(10,2), paye_a_temps smallint"


@pytest.fixture(scope="module")
def feed(spark):
    rows = [(k, k % 40, D, None, 1) for k in range(2000)]
    rows += [(7, 3, D, None, 1)] * 900                              # a key with a third of the rows
    rows += [(5000, None, D, None, 0), (5001, 99, D, None, 1), (5001, 99, None, None, 3), (None, 1, D, None, 1),
             (None, 98, None, None, 1), (5002, 2, D, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def done(spark, feed):
    clients = spark.createDataFrame([(k,) for k in range(40)] + [(3,)], "client_id bigint")
    return ingest.write_checked(feed, CONTRACT, shared_dir(spark, "ingest"), {"clients": clients}), clients


def test_every_row_once(feed, done):
    got, _ = done
    both = got.valid.unionByName(got.rejected.drop("reasons"))
    assert both.exceptAll(feed).count() == 0 and feed.exceptAll(both).count() == 0
    assert got.counts["rows"] == feed.count() == got.counts["valid"] + got.counts["rejected"]
    assert got.valid.count() == got.counts["valid"] == 1999 + 2
    reasons = {(r.facture_id, r.date_facture is None): sorted(r.reasons) for r in got.rejected.filter("facture_id IS NULL OR facture_id > 4000").collect()}
    assert reasons == {
        (5001, False): ["client_id: orphan", "facture_id: duplicate"],
        (5001, True): ["client_id: orphan", "date_facture: null", "facture_id: duplicate", "paye_a_temps: domain"],
        (None, False): ["facture_id: null"], (None, True): ["client_id: orphan", "date_facture: null", "facture_id: null"]}


def test_counts_equal_the_separate_checks(feed, done):
    got, clients = done
    counts = got.counts
    unique = quality.dq_unique(feed, "facturation", "facture_id").first()
    assert counts["facture_id: duplicate"] == unique.n_duplicate_rows and counts["facture_id: null"] == unique.n_null_keys
    orphans = quality.dq_orphans(feed, "facturation", "client_id", clients, "clients", "client_id").first()
    assert counts["client_id: orphan"] == orphans.n_orphan_rows
    for r in quality.dq_nulls(feed, "facturation", CONTRACT.not_null).collect():
        assert counts[f"{r.column_name}: null"] == r.n_nulls
    for r in quality.dq_domain(feed, CONTRACT).collect():
        assert counts[f"{r.column_name}: {r.rule}"] == r.n_violations


def test_the_feed_is_read_once(spark, feed, tmp_path):
    feed.write.parquet(str(tmp_path / "feed"))
    source = spark.read.parquet(str(tmp_path / "feed"))
    rows, _ = ingest.marked(source, CONTRACT, {"clients": feed.select("client_id")})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan       # what follows reads the materialised rows
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


def test_clean_and_empty_feeds(spark, feed):
    clients = spark.createDataFrame([(1,)], "client_id bigint")
    clean = spark.createDataFrame([(1, 1, D, None, 1)], SCHEMA)
    got = ingest.write_checked(clean, CONTRACT, shared_dir(spark, "ingest"), {"clients": clients})
    assert (got.valid.count(), got.rejected.count(), got.counts["rows"]) == (1, 0, 1)
    got = ingest.write_checked(feed.filter(F.lit(False)), CONTRACT, shared_dir(spark, "ingest"), {"clients": clients})
    assert (got.valid.count(), got.rejected.count(), got.counts["rows"]) == (0, 0, 0)
