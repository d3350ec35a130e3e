from decimal import Decimal

import pytest

from attrition.plans import features as feat
from tests import golden

COLS = ("tenure_mois", "type_contrat", "charges_mensuelles", "categorie_produit", "nb_factures",
        "total_charges", "nb_retards_paiement", "ratio_retards_paiement", "nb_interactions_support",
        "nb_contacts_resiliation", "taux_resolution_support", "total_connexions_12_mois",
        "connexions_moy_3derniers_mois", "connexions_moy_3mois_avant", "evolution_connexions_ratio", "churn")

EXPECTED = {
    "C1": (6, "Mensuel", Decimal("40.00"), "Mobile", 2, Decimal("150.00"), 1, 0.5, 0, 0, 1.0, 280, 60.0, 30.0,
           1.0, 0),
    "C2": (31, "Mensuel", Decimal("35.00"), "Internet", 0, Decimal("0.00"), 0, 0.0, 3, 2, 2 / 3, 12, 6.0, 0.0,
           0.0, 1),
    "C3": (58, "2_ans", Decimal("35.00"), "Internet", 0, Decimal("0.00"), 0, 0.0, 1, 0, 0.0, 0, 0.0, 0.0, 0.0, 0),
    "C7": (0, "Mensuel", Decimal("25.00"), "Mobile", 0, Decimal("0.00"), 0, 0.0, 0, 0, 1.0, 15, 5.0, 0.0, 0.0, 0),
    "C8": (71, "1_an", Decimal("66.00"), "Mobile", 0, Decimal("0.00"), 0, 0.0, 0, 0, 1.0, 450, 50.0, 100.0,
           -0.5, 0),
}


@pytest.fixture(scope="module")
def tables(spark):
    return golden.tables(spark)


def _rows(df):
    return {r["client_id"]: r for r in df.collect()}


def test_sql_rule_golden_rows(tables):
    df = feat.features_onerow(tables, golden.REF, golden.START)
    rows = _rows(df)
    assert set(rows) == set(EXPECTED)          # C4 (future), C5 (unknown product), C6 (none) absent
    for cid, expected in EXPECTED.items():
        got = tuple(rows[cid][c] for c in COLS)
        assert got == pytest.approx(expected), cid
    assert df.columns == list(feat.FEATURE_COLUMNS)


def test_ordered_output(tables):
    ids = [r.client_id for r in feat.features_onerow(tables, golden.REF, golden.START).collect()]
    assert ids == sorted(ids)


def test_export_profile_has_volume(tables):
    df = feat.build_features(tables, golden.REF, golden.START)
    assert df.columns == list(feat.EXPORT_COLUMNS)
    assert len(df.columns) == 25


def test_script_variant(tables):
    rows = _rows(feat.features_script_variant(tables, golden.REF, golden.START))
    assert set(rows) == {"C1", "C2", "C3", "C4", "C5", "C7", "C8"}
    for cid in ("C1", "C7", "C8"):
        assert rows[cid]["taux_resolution_support"] == 0.0
    assert rows["C4"]["tenure_mois"] == 0
    assert rows["C5"]["categorie_produit"] is None
    assert rows["C1"]["tenure_mois"] == 6
    assert rows["C2"]["tenure_mois"] == 31


def test_days30_tenure_for_tied_client(tables):
    opts = feat.FeatureOptions(tenure_mode="days30")
    rows = _rows(feat.build_features(tables, golden.REF, golden.START, options=opts))
    assert rows["C8"]["tenure_mois"] == 73


def test_label_from_id_set(spark, tables):
    ids = spark.createDataFrame([("C1",), ("C1",), ("C9",)], "client_id string")
    rows = _rows(feat.build_features(tables, golden.REF, golden.START, label_ids=ids))
    assert rows["C1"]["churn"] == 1
    assert rows["C2"]["churn"] == 0


def test_invariant_under_row_order(tables):
    shuffled = {k: v.orderBy(v.columns[-1]).repartition(3) for k, v in tables.items()}
    a = sorted(map(tuple, feat.features_onerow(tables, golden.REF, golden.START).collect()))
    b = sorted(map(tuple, feat.features_onerow(shuffled, golden.REF, golden.START).collect()))
    assert a == b


def test_trend_forms_agree(tables):
    bands = feat.build_features(tables, golden.REF, golden.START)
    outer = feat.build_features(tables, golden.REF, golden.START, options=feat.FeatureOptions(trend_form="outer"))
    cols = ["client_id", "connexions_moy_3derniers_mois", "connexions_moy_3mois_avant",
            "evolution_connexions_ratio", "total_connexions_12_mois"]
    assert sorted(map(tuple, bands.select(cols).collect())) == sorted(map(tuple, outer.select(cols).collect()))


def test_script_variant_takes_last_nonnull_per_column(spark, tables):
    """The script keeps, per column, the last non-null value in start-date
    order; the SQL rule drops the unknown-product row and keeps a whole row."""
    cols = [("abonnement_id", "long"), ("client_id", "string"), ("produit_id", "string"),
            ("date_debut", "date"), ("date_fin", "date"), ("tarif_mensuel", "decimal(10,2)"),
            ("type_contrat", "string"), ("statut", "string")]
    extra = golden._frame(spark, "abonnements", cols, [
        (20, "C6", "P2", golden.D("2023-03-01"), golden.D("2023-09-01"), Decimal("20"), "1_an", "résilié"),
        (21, "C6", None, golden.D("2024-02-01"), None, Decimal("22"), "Mensuel", "actif"),
    ])
    t = dict(tables, abonnements=tables["abonnements"].unionByName(extra))
    script = _rows(feat.features_script_variant(t, golden.REF, golden.START))["C6"]
    assert (script["categorie_produit"], script["type_contrat"], script["charges_mensuelles"],
            script["tenure_mois"], script["churn"]) == ("Mobile", "Mensuel", Decimal("22.00"), 11, 0)
    sql = _rows(feat.features_onerow(t, golden.REF, golden.START))["C6"]
    assert (sql["categorie_produit"], sql["type_contrat"], sql["charges_mensuelles"],
            sql["tenure_mois"], sql["churn"]) == ("Mobile", "1_an", Decimal("20.00"), 21, 0)
