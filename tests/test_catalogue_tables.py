"""Tables with DEFAULT clauses in the session's catalogue, filled by INSERTs that leave columns out."""

import datetime as dt
from decimal import Decimal

import pytest

from attrition.sources import store
from attrition.sources.schema import TABLES, contracts

D = dt.date(2024, 5, 1)


def test_six_tables_with_their_defaults(spark):
    with store.catalogue_tables(spark) as tables:
        for name in TABLES:
            found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {tables.name(name)}").collect()}
            assert [f.name for f in contracts()[name].schema.fields if f.name in found] == contracts()[name].columns
            text = spark.sql(f"SHOW CREATE TABLE {tables.name(name)}").first()[0]
            assert text.count("DEFAULT") == len(contracts()[name].defaults)
            part = store.PARTITION_BY[name]
            assert (f"PARTITIONED BY ({part})" in text) == bool(part)
        schema = tables.schema
    assert not [r for r in spark.sql("SHOW SCHEMAS").collect() if r[0] == schema]


def test_omitted_columns_take_defaults_and_nulls_stay(spark):
    with store.catalogue_tables(spark) as tables:
        tables.insert("abonnements", spark.createDataFrame([(1, "c1", D)], "abonnement_id bigint, client_id string, date_debut date"))
        tables.insert("abonnements", spark.createDataFrame([(2, D, None)], "abonnement_id bigint, date_debut date, statut string"))
        tables.insert("usage_mensuel", spark.createDataFrame([(7, D, 3)], "usage_id bigint, mois date, nb_connexions int"))
        now = spark.sql("SELECT localtimestamp()").first()[0]
        subs = {r.abonnement_id: r for r in tables.stored("abonnements").collect()}
        assert subs[1].statut == "actif" and subs[2].statut is None and subs[1].produit_id is None
        assert abs((subs[1].created_at - now).total_seconds()) < 600
        usage = tables.stored("usage_mensuel").first()
        assert (usage.nb_connexions, usage.volume_data_go, usage.duree_appels_min) == (3, Decimal("0.00"), 0)
        assert spark.table(tables.name("abonnements")).count() == 2
        later = tables.stored("usage_mensuel")
    assert later.count() == 1       # the files outlive the catalogue's entry


def test_not_null_columns(spark):
    with store.catalogue_tables(spark) as tables:
        with pytest.raises(Exception, match="null in facturation.date_facture"):
            tables.insert("facturation", spark.createDataFrame([(1, None)], "facture_id bigint, date_facture date"))
        with pytest.raises(ValueError, match="needs date_facture"):
            tables.insert("facturation", spark.createDataFrame([(1,)], "facture_id bigint"))
        assert tables.stored("facturation").count() == 0
