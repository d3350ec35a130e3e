"""Ranking before the product lookup picks the same subscriptions as looking up first."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from attrition.operators.subscriptions import latest_rank_first, latest_subscription
from attrition.sources.testtables import TEST_REF, load_tables

SF = "/root/testdata/sf0.001"
COLUMNS = ("client_id", "abonnement_id", "produit_id", "date_debut", "categorie_produit")


def _rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("known", ["produit_id % 5 <> 0", "true", "false"])
def test_unknown_products(spark, known):
    t = load_tables(spark, SF)
    some = t["produits"].filter(known)
    want = _rows(latest_subscription(t["abonnements"], some, TEST_REF))
    assert _rows(latest_rank_first(t["abonnements"], some, TEST_REF)) == want and bool(want) == (known != "false")


def test_ties_null_clients_and_a_hot_client(spark):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    rows = [(k, rng.choice([1, 1, 1, None, *range(2, 40)]), rng.choice([None, *range(8)]), day + dt.timedelta(days=rng.randint(0, 20)))
            for k in range(3000)]
    subs = spark.createDataFrame(rows, "abonnement_id bigint, client_id bigint, produit_id bigint, date_debut date")
    products = spark.createDataFrame([(k, f"c{k}") for k in (0, 2, 5)], "produit_id bigint, categorie string")
    ref = day + dt.timedelta(days=15)
    assert _rows(latest_rank_first(subs, products, ref)) == _rows(latest_subscription(subs, products, ref))


def test_one_row_per_client_moves_by_product(spark):
    t = load_tables(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen = []
    try:
        from attrition.operators import subscriptions

        kept, subscriptions.cut_lineage = subscriptions.cut_lineage, lambda df: seen.append(df) or kept(df)
        latest_rank_first(t["abonnements"], t["produits"].filter(F.col("produit_id") > 0), TEST_REF)
    finally:
        subscriptions.cut_lineage = kept
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    by_product = plan[plan.index("Exchange hashpartitioning(produit_id"):]
    assert "(_rn#" in by_product.splitlines()[1] or "_rn" in by_product.splitlines()[2]      # ranked rows below the exchange
    assert plan.count("WindowGroupLimit") >= 2
