"""Usage without a client is a group of its own under the SQL rules and dropped under the script's."""

import datetime as dt
from decimal import Decimal

from attrition.operators import activity
from attrition.sources import files

START, REF = dt.date(2024, 1, 1), dt.date(2024, 12, 31)


def _usage(spark):
    rows = [(1, 7, dt.date(2024, 1, 1), 10, Decimal("1.50")), (2, 7, dt.date(2024, 2, 1), 20, Decimal("2.50")),
            (3, None, dt.date(2024, 1, 1), 5, Decimal("0.50")), (4, None, dt.date(2024, 3, 1), 9, Decimal("1.00"))]
    return spark.createDataFrame(
        rows, "usage_id bigint, client_id bigint, mois date, nb_connexions int, volume_data_go decimal(10,2)")


def test_rankings_keep_null_clients(spark):
    usage = _usage(spark)
    assert {(r.client_id, r.usage_id, r.rn_mois) for r in activity.usage_ranked(usage, START, REF).collect()} == {
        (7, 2, 1), (7, 1, 2), (None, 4, 1), (None, 3, 2)}
    assert {(r.usage_id, r.rn, r.reverse_rn) for r in activity.reverse_rank(usage, START, REF).collect()} == {
        (1, 0, 1), (2, 1, 0), (3, 0, 1), (4, 1, 0)}


def test_trend_keeps_the_null_group_once(spark):
    got = {r.client_id: (r.total_connexions_12_mois, r.connexions_3derniers_mois)
           for r in activity.usage_trend(_usage(spark), START, REF).collect()}
    assert got == {7: (30, 15.0), None: (14, 7.0)}


def test_script_trend_drops_null_clients(spark):
    got = [(r.client_id, r.total_connexions_12_mois) for r in activity.usage_trend_outer(_usage(spark), START, REF).collect()]
    assert got == [(7, 30)]


def test_script_counts_rows_with_a_value_only(spark):
    bills = spark.createDataFrame([(7, dt.date(2024, 5, 1), Decimal("1.00"), 1), (7, dt.date(2024, 6, 1), None, 0)],
                                  "client_id bigint, date_facture date, montant decimal(10,2), paye_a_temps int")
    assert activity.agg_billing(bills, START, REF).first().nb_factures == 2
    assert activity.agg_billing(bills, START, REF, count_nulls=False).first().nb_factures == 1


def test_csv_keeps_texts(spark, tmp_path):
    texts = ['say "hi", x', "two\nlines", "", None, "été, à l'ombre", " spaced "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    back = files.read_csv(spark, files.write_csv(df, str(tmp_path / "out")), df.schema)
    assert {r.i: r.t for r in back.collect()} == dict(enumerate(texts))
    plain = tmp_path / "plain.csv"
    plain.write_text('﻿i,t\n1,"say ""hi"", x"\n2,"a\nb"\n3,\n', encoding="utf-8")
    assert {r.i: r.t for r in files.read_csv(spark, str(plain), df.schema).collect()} == {
        1: 'say "hi", x', 2: "a\nb", 3: None}
