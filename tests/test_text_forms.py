"""Equality of texts whatever way their accents are stored."""

import unicodedata

from pyspark.sql import functions as F

from attrition.functions import equivalent_forms, one_spelling, same_text
from attrition.operators.quality import conform, dq_domain
from attrition.operators.subscriptions import churn_flag
from attrition.sources.schema import DOMAINS, STATUS_CANCELLED, contracts

import datetime as dt

START = dt.date(2024, 1, 1)


def test_all_forms_of_each_domain_value():
    for values in DOMAINS.values():
        for v in values:
            if isinstance(v, str):
                forms = equivalent_forms(v)
                assert forms[0] == unicodedata.normalize("NFC", v) and len(set(forms)) == len(forms)
                assert {unicodedata.normalize("NFC", x) for x in forms} == {forms[0]}
                assert unicodedata.normalize("NFD", v) in forms
    assert len(equivalent_forms("résilié")) == 4 and equivalent_forms("actif") == ["actif"]
    assert set(equivalent_forms("\u01d8")) == {"\u01d8", "\u00fc\u0301", "u\u0308\u0301"}


def test_label_and_ingest(spark):
    end = dt.date(2024, 6, 1)
    forms = equivalent_forms(STATUS_CANCELLED)
    rows = [(k, f, end) for k, f in enumerate([*forms, "resilie", "Résilié", None, "actif", "rési­lié"])]
    df = spark.createDataFrame(rows, "abonnement_id bigint, statut string, date_fin date")
    got = [r.churn for r in df.select("abonnement_id", churn_flag(START).alias("churn")).orderBy("abonnement_id").collect()]
    assert got == [1, 1, 1, 1, 0, 0, 0, 0, 0]
    assert [r.s for r in df.select("abonnement_id", same_text(F.col("statut"), "résilié").alias("s")).orderBy(
        "abonnement_id").collect()] == [True] * 4 + [False, False, None, False, False]
    spelt = [r.s for r in df.select("abonnement_id", one_spelling(F.col("statut"), DOMAINS[("abonnements", "statut")]).alias("s"))
             .orderBy("abonnement_id").collect()]
    assert spelt == ["résilié"] * 4 + [r[1] for r in rows[4:]]


def test_conformed_feed_passes_the_domain_check(spark):
    contract = contracts()["interactions_support"]
    feed = spark.createDataFrame([(1, unicodedata.normalize("NFD", "résiliation")), (2, "autre"), (3, None)],
                                 "interaction_id bigint, theme string").withColumn("date_interaction", F.lit(START))
    rules = dq_domain(conform(feed, contract), contract).filter("column_name = 'theme' AND rule = 'domain'").collect()
    assert [r.n_violations for r in rules] == [1]


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("actif",), ("résilié",)], "statut string").write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).filter(same_text(F.col("statut"), "résilié"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [In(statut" in plan and "Python" not in plan
