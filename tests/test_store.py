from attrition.plans import features as feat
from attrition.operators import activity
from attrition.sources import store
from attrition.sources.files import shared_dir
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables

SF = "/root/testdata/sf0.001"


def test_saved_layout_same_features_and_pruned(spark):
    tables = load_tables(spark, SF)
    loc = store.save_tables(tables, shared_dir(spark, "store"))
    saved = store.load_tables(spark, loc, {k: v.schema for k, v in tables.items()})
    a = sorted(map(tuple, feat.features_onerow(tables, TEST_REF, TEST_START).collect()))
    b = sorted(map(tuple, feat.features_onerow(saved, TEST_REF, TEST_START).collect()))
    assert a == b
    plan = activity.agg_billing(saved["facturation"], TEST_START, TEST_REF)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_facture" in plan and "2000-01-01" in plan
    # on stored tables the flagship has only its own exchanges: one per input
    # on client_id (one more pair for the product lookup) and the final order
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagship = feat.features_onerow(saved, TEST_REF, TEST_START)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "orderkey" not in flagship
    assert flagship.count("Exchange hashpartitioning(client_id") == 6
    assert flagship.count("Exchange hashpartitioning(produit_id") == 2
    assert flagship.count("Exchange rangepartitioning(client_id") == 1
    assert flagship.count("Exchange ") == 9


def test_source_tables_are_lazy_and_share_reads(spark):
    tables = load_tables(spark, SF)
    fact = tables["facturation"]
    # only the driver tables this source needs were read, each once
    assert sorted(tables._raw) == ["lineitem", "orders"]
    assert tables["facturation"] is fact
    tables["usage_mensuel"]
    tables["abonnements"]
    assert sorted(tables._raw) == ["lineitem", "orders"]
    assert sorted(tables) == sorted(store.PARTITION_BY)
    # sharing one relation across branches still plans and runs (self-join dedup)
    assert feat.features_onerow(tables, TEST_REF, TEST_START).count() > 0


def test_views_run_sql_written_for_the_tables(spark):
    tables = load_tables(spark, SF)
    assert store.register_views(tables) == list(store.PARTITION_BY)
    got = spark.sql(
        """SELECT f.client_id, COUNT(*) AS nb_factures, SUM(f.montant) AS total_charges
           FROM facturation f
           WHERE f.date_facture BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
           GROUP BY f.client_id""")
    want = activity.agg_billing(tables["facturation"], TEST_START, TEST_REF).select(
        "client_id", "nb_factures", "total_charges")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_saved_facts_are_clustered_by_client(spark):
    """The stand-in for the client_id indexes: every written fact file is
    ordered by client, so row-group statistics can skip other clients."""
    import glob

    import pyarrow.parquet as pq

    import datetime as dt

    from pyspark.sql import functions as F

    tables = load_tables(spark, "/root/testdata/sf0.01")
    # one month of facts keeps the number of date directories small
    month = {"abonnements": "date_debut", "facturation": "date_facture",
             "interactions_support": "date_interaction", "usage_mensuel": "mois"}
    small = {k: (tables[k].filter(F.col(month[k]).between(dt.date(2000, 1, 1), dt.date(2000, 1, 31)))
                 if k in month else tables[k]) for k in store.PARTITION_BY}
    loc = store.save_tables(small, shared_dir(spark, "store"))
    for name in ("facturation", "usage_mensuel"):
        local = loc.removeprefix("file:")
        files = glob.glob(f"{local}/{name}/*/*.parquet")
        assert files
        for path in files:
            ids = pq.read_table(path, columns=["client_id"]).column("client_id").to_pylist()
            assert ids == sorted(ids), path
    for path in glob.glob(f"{loc.removeprefix('file:')}/clients/*.parquet"):
        ids = pq.read_table(path, columns=["client_id"]).column("client_id").to_pylist()
        assert ids == sorted(ids), path
    saved = store.load_tables(spark, loc)
    plan = saved["facturation"].filter("client_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(client_id), EqualTo(client_id,7)]" in plan
