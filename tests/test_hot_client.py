"""The flagship with one client holding a third of every fact table, checked
against a brute-force computation in plain Python (no Spark, no SQL)."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from attrition.plans import features as feat
from tests import golden

D = dt.date
REF, START = golden.REF, golden.START
HOT = "H"


def _fixture(seed=7):
    rnd = random.Random(seed)
    ids = [f"C{i:02d}" for i in range(30)]
    prods = {"P1": "Internet", "P2": "Mobile", "P3": "Bundle"}
    day = lambda lo, hi: lo + dt.timedelta(days=rnd.randrange((hi - lo).days + 1))

    subs, bills, contacts, usage = [], [], [], []

    def add_client(cid, n_subs, n_bills, n_contacts, n_usage):
        for _ in range(n_subs):
            start = day(D(2019, 1, 1), D(2025, 3, 1))
            cancelled = rnd.random() < 0.4
            end = day(start, D(2025, 6, 1)) if cancelled else None
            subs.append((len(subs) + 1, cid, rnd.choice(["P1", "P2", "P3", "PX"]), start, end,
                         Decimal(rnd.randrange(1000, 9000)) / 100, rnd.choice(["Mensuel", "1_an", "2_ans"]),
                         "résilié" if cancelled else "actif"))
        for _ in range(n_bills):
            bills.append((len(bills) + 1, cid, day(D(2023, 10, 1), D(2025, 2, 1)),
                          Decimal(rnd.randrange(500, 20000)) / 100, rnd.choice([0, 1, 1])))
        for _ in range(n_contacts):
            contacts.append((len(contacts) + 1, cid, day(D(2023, 10, 1), D(2025, 2, 1)),
                             rnd.choice(["résiliation", "technique", "facturation"]), rnd.choice([0, 1])))
        for _ in range(n_usage):
            usage.append((len(usage) + 1, cid, D(rnd.choice([2023, 2024, 2024, 2025]), rnd.randrange(1, 13), 1),
                          rnd.randrange(0, 200)))

    for cid in ids:
        if rnd.random() < 0.9:
            add_client(cid, rnd.randrange(1, 4), rnd.randrange(0, 30), rnd.randrange(0, 6), rnd.randrange(0, 14))
    n = (len(subs), len(bills), len(contacts), len(usage))
    # the hot client: half as many rows as everybody else together = a third of each table
    add_client(HOT, n[0] // 2, n[1] // 2, n[2] // 2, n[3] // 2)
    return ids + [HOT], prods, subs, bills, contacts, usage


def _months(ref, d):
    return (ref.year - d.year) * 12 + (ref.month - d.month) - (1 if ref.day < d.day else 0)


def _brute_force(ids, prods, subs, bills, contacts, usage):
    out = {}
    for cid in ids:
        mine = [s for s in subs if s[1] == cid and s[3] <= REF and s[2] in prods]
        if not mine:
            continue
        best = max(mine, key=lambda s: (s[3], s[0]))
        b = [x for x in bills if x[1] == cid and START <= x[2] <= REF]
        c = [x for x in contacts if x[1] == cid and START <= x[2] <= REF]
        u = sorted((x for x in usage if x[1] == cid and START <= x[2] <= REF), key=lambda x: (x[2], x[0]),
                   reverse=True)
        last = [x[3] for x in u[:3]]
        prev = [x[3] for x in u[3:6]]
        l3 = sum(last) / len(last) if last else None
        p3 = sum(prev) / len(prev) if prev else None
        late = sum(1 for x in b if x[4] == 0)
        out[cid] = (
            _months(REF, best[3]), best[6], best[5], prods[best[2]],
            len(b), sum((x[3] for x in b), Decimal("0")), late, late / len(b) if b else 0.0,
            len(c), sum(1 for x in c if x[3] == "résiliation"),
            sum(x[4] for x in c) / len(c) if c else 1.0,
            sum(x[3] for x in u),
            l3 or 0.0, p3 or 0.0,
            (l3 - p3) / p3 if p3 else 0.0,
            1 if best[7] == "résilié" and best[4] is not None and best[4] >= START else 0,
        )
    return out


COLS = ("tenure_mois", "type_contrat", "charges_mensuelles", "categorie_produit", "nb_factures",
        "total_charges", "nb_retards_paiement", "ratio_retards_paiement", "nb_interactions_support",
        "nb_contacts_resiliation", "taux_resolution_support", "total_connexions_12_mois",
        "connexions_moy_3derniers_mois", "connexions_moy_3mois_avant", "evolution_connexions_ratio", "churn")


def test_flagship_with_hot_client_matches_brute_force(spark):
    ids, prods, subs, bills, contacts, usage = _fixture()
    f = golden._frame
    tables = {
        "clients": f(spark, "clients", [("client_id", "string"), ("date_inscription", "date")],
                     [(c, D(2019, 1, 1)) for c in ids]),
        "produits": f(spark, "produits", [("produit_id", "string"), ("categorie", "string")],
                      list(prods.items())),
        "abonnements": f(spark, "abonnements",
                         [("abonnement_id", "long"), ("client_id", "string"), ("produit_id", "string"),
                          ("date_debut", "date"), ("date_fin", "date"), ("tarif_mensuel", "decimal(10,2)"),
                          ("type_contrat", "string"), ("statut", "string")], subs),
        "facturation": f(spark, "facturation",
                         [("facture_id", "long"), ("client_id", "string"), ("date_facture", "date"),
                          ("montant", "decimal(10,2)"), ("paye_a_temps", "short")], bills),
        "interactions_support": f(spark, "interactions_support",
                                  [("interaction_id", "long"), ("client_id", "string"),
                                   ("date_interaction", "date"), ("theme", "string"),
                                   ("resolution_satisfaisante", "short")], contacts),
        "usage_mensuel": f(spark, "usage_mensuel",
                           [("usage_id", "long"), ("client_id", "string"), ("mois", "date"),
                            ("nb_connexions", "int")], usage),
    }
    # spread the input over several partitions so the hot client is split map-side
    tables = {k: v.repartition(5) for k, v in tables.items()}
    want = _brute_force(ids, prods, subs, bills, contacts, usage)
    assert HOT in want
    got = {r["client_id"]: tuple(r[c] for c in COLS)
           for r in feat.features_onerow(tables, REF, START).collect()}
    assert set(got) == set(want)
    for cid, expected in want.items():
        assert got[cid] == pytest.approx(expected), cid


def _brute_force_script(ids, prods, subs, bills, contacts, usage):
    """Script rules: per-column last non-null pick over every subscription,
    30-day tenure, unknown product kept with a null category, rate 0 without contact."""
    out = {}
    for cid in ids:
        mine = sorted((s for s in subs if s[1] == cid), key=lambda s: (s[3], s[0]))
        if not mine:
            continue
        last = {i: next((s[i] for s in reversed(mine) if s[i] is not None), None) for i in range(2, 8)}
        c = [x for x in contacts if x[1] == cid and START <= x[2] <= REF]
        rest = _activity_only(cid, bills, contacts, usage)
        out[cid] = (
            max(0, (REF - last[3]).days // 30), last[6], last[5], prods.get(last[2]),
            *rest[4:10], sum(x[4] for x in c) / len(c) if c else 0.0, *rest[11:15],
            1 if last[7] == "résilié" and last[4] is not None and last[4] >= START else 0,
        )
    return out


def _activity_only(cid, bills, contacts, usage):
    # the activity columns do not depend on the subscription: reuse the SQL
    # brute force with a stand-in subscription that is always retained
    stand_in = [(0, cid, "P", D(2000, 1, 1), None, Decimal("0"), "x", "actif")]
    return _brute_force([cid], {"P": "x"}, stand_in, bills, contacts, usage)[cid]


def test_script_variant_with_hot_client_matches_brute_force(spark):
    ids, prods, subs, bills, contacts, usage = _fixture(seed=11)
    f = golden._frame
    tables = {
        "clients": f(spark, "clients", [("client_id", "string"), ("date_inscription", "date")],
                     [(c, D(2019, 1, 1)) for c in ids]),
        "produits": f(spark, "produits", [("produit_id", "string"), ("categorie", "string")],
                      list(prods.items())),
        "abonnements": f(spark, "abonnements",
                         [("abonnement_id", "long"), ("client_id", "string"), ("produit_id", "string"),
                          ("date_debut", "date"), ("date_fin", "date"), ("tarif_mensuel", "decimal(10,2)"),
                          ("type_contrat", "string"), ("statut", "string")], subs),
        "facturation": f(spark, "facturation",
                         [("facture_id", "long"), ("client_id", "string"), ("date_facture", "date"),
                          ("montant", "decimal(10,2)"), ("paye_a_temps", "short")], bills),
        "interactions_support": f(spark, "interactions_support",
                                  [("interaction_id", "long"), ("client_id", "string"),
                                   ("date_interaction", "date"), ("theme", "string"),
                                   ("resolution_satisfaisante", "short")], contacts),
        "usage_mensuel": f(spark, "usage_mensuel",
                           [("usage_id", "long"), ("client_id", "string"), ("mois", "date"),
                            ("nb_connexions", "int")], usage),
    }
    tables = {k: v.repartition(5) for k, v in tables.items()}
    want = _brute_force_script(ids, prods, subs, bills, contacts, usage)
    got = {r["client_id"]: tuple(r[c] for c in COLS)
           for r in feat.features_script_variant(tables, REF, START).collect()}
    assert set(got) == set(want)
    for cid, expected in want.items():
        assert got[cid] == pytest.approx(expected), cid
