"""Golden micro-tables: eight hand-made clients, each hitting one edge case
(ref = 2024-12-31, start = 2024-01-01)."""

import datetime as dt
from decimal import Decimal

from attrition.operators.quality import conform
from attrition.sources.schema import contracts

D = dt.date.fromisoformat
REF = D("2024-12-31")
START = D("2024-01-01")
C = contracts()


def _frame(spark, table, columns, rows):
    df = spark.createDataFrame(rows, schema=", ".join(f"{c} {t}" for c, t in columns))
    return conform(df, C[table])


def tables(spark):
    clients = _frame(
        spark, "clients",
        [("client_id", "string"), ("date_inscription", "date"), ("genre", "string"), ("region", "string")],
        [(f"C{i}", D("2019-01-01"), "Male" if i % 2 else "Female", "Nord") for i in range(1, 9)],
    )
    produits = _frame(
        spark, "produits", [("produit_id", "string"), ("categorie", "string")],
        [("P1", "Internet"), ("P2", "Mobile")],
    )
    abo_cols = [("abonnement_id", "long"), ("client_id", "string"), ("produit_id", "string"),
                ("date_debut", "date"), ("date_fin", "date"), ("tarif_mensuel", "decimal(10,2)"),
                ("type_contrat", "string"), ("statut", "string")]
    m = Decimal
    abonnements = _frame(spark, "abonnements", abo_cols, [
        (1, "C1", "P1", D("2023-01-15"), None, m("30"), "1_an", "actif"),
        (2, "C1", "P2", D("2024-06-15"), None, m("40"), "Mensuel", "actif"),
        (3, "C2", "P1", D("2022-05-31"), D("2024-11-10"), m("35"), "Mensuel", "résilié"),
        (4, "C3", "P1", D("2020-02-29"), D("2023-12-31"), m("35"), "2_ans", "résilié"),
        (5, "C4", "P1", D("2025-01-01"), None, m("35"), "1_an", "actif"),
        (6, "C5", "PX", D("2024-03-01"), None, m("35"), "1_an", "actif"),
        (7, "C7", "P2", D("2024-12-31"), None, m("25"), "Mensuel", "actif"),
        (8, "C8", "P1", D("2019-01-01"), None, m("65"), "2_ans", "actif"),
        (9, "C8", "P2", D("2019-01-01"), None, m("66"), "1_an", "actif"),
    ])
    facturation = _frame(
        spark, "facturation",
        [("facture_id", "long"), ("client_id", "string"), ("date_facture", "date"),
         ("montant", "decimal(10,2)"), ("paye_a_temps", "short")],
        [(1, "C1", D("2024-01-01"), m("100"), 1), (2, "C1", D("2024-12-31"), m("50"), 0),
         (3, "C1", D("2023-12-31"), m("999"), 0), (4, "C1", D("2025-01-01"), m("999"), 0)],
    )
    may5 = D("2024-05-05")
    interactions = _frame(
        spark, "interactions_support",
        [("interaction_id", "long"), ("client_id", "string"), ("date_interaction", "date"),
         ("theme", "string"), ("resolution_satisfaisante", "short")],
        [(1, "C2", may5, "résiliation", 0), (2, "C2", may5, "résiliation", 1), (3, "C2", may5, "technique", 1),
         (4, "C3", may5, "facturation", 0)],
    )
    usage_rows = []
    uid = 0

    def add(client, months, values):
        nonlocal uid
        for mth, v in zip(months, values):
            uid += 1
            usage_rows.append((uid, client, D(mth), v))

    add("C1", [f"2024-{k:02d}-01" for k in range(6, 13)], [10, 20, 30, 40, 50, 60, 70])
    add("C2", ["2024-10-01", "2024-11-01"], [5, 7])
    add("C3", ["2023-06-01"], [9])
    add("C7", [f"2024-{k:02d}-01" for k in range(9, 13)], [0, 5, 5, 5])
    add("C8", [f"2024-{k:02d}-01" for k in range(7, 13)], [100, 100, 100, 50, 50, 50])
    usage = _frame(
        spark, "usage_mensuel",
        [("usage_id", "long"), ("client_id", "string"), ("mois", "date"), ("nb_connexions", "int")],
        usage_rows,
    )
    return {
        "clients": clients, "produits": produits, "abonnements": abonnements, "facturation": facturation,
        "interactions_support": interactions, "usage_mensuel": usage,
    }
