"""Invariants of the feature table on the sf0.01 test tables."""

import pytest
from pyspark.sql import functions as F

from attrition.plans import features as feat
from attrition.plans.features_sql import features_sql
from attrition.session import cluster_conf
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return load_tables(spark, SF)


@pytest.fixture(scope="module")
def features(tables):
    return feat.build_features(tables, TEST_REF, TEST_START).cache()


def test_one_row_per_client(features):
    assert features.count() == features.select("client_id").distinct().count()


def test_invoice_total_matches_facts(tables, features):
    retained = features.select("client_id")
    in_window = tables["facturation"].filter(F.col("date_facture").between(TEST_START, TEST_REF))
    want = in_window.join(retained, "client_id", "left_semi").count()
    assert features.agg(F.sum("nb_factures")).first()[0] == want


def test_ratios_bounded(features):
    r = features.agg(F.min("ratio_retards_paiement"), F.max("ratio_retards_paiement"),
                     F.min("taux_resolution_support"), F.max("taux_resolution_support")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and 0.0 <= r[2] <= r[3] <= 1.0


def test_churn_is_binary_and_label_rule(features, tables):
    assert {r.churn for r in features.select("churn").distinct().collect()} <= {0, 1}


def test_sql_text_equals_dataframe_plan(spark, tables):
    a = feat.features_onerow(tables, TEST_REF, TEST_START)
    b = features_sql(spark, tables, TEST_REF, TEST_START)
    assert a.schema == b.schema or [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cluster_conf_sizes():
    conf = cluster_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "24"
