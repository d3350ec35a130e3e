"""One feature row per client (the flagship dataflow) and its variants.

``build_features`` is the SQL rule; ``FeatureOptions`` switch to the script
rules where the two disagree (tenure in 30-day months, future and
unknown-product subscriptions kept, resolution rate 0 without contact,
label from an id set).

Physical shape (checked with ``explain``):
* one shuffle on ``client_id`` per fact table, each after a map-side partial
  aggregate (billing, support, usage totals) or partial top-k (latest
  subscription, usage bands);
* the four per-client relations are all hash-partitioned on ``client_id``
  and joined with sort-merge joins that add no further exchange (AQE turns a
  side into a broadcast only when its runtime size is under the threshold);
* no cross join: the period bounds are literals that reach the scans;
* the global order, when asked for, is a range exchange at the very end.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions import membership_flag, relative_change, safe_ratio
from attrition.operators.activity import agg_billing, agg_support, usage_trend, usage_trend_outer
from attrition.operators.subscriptions import churn_flag, latest_subscription, last_nonnull, with_tenure
from attrition.sources.schema import EXPORT_COLUMNS, FEATURE_COLUMNS

# --- fixed values: reporting window of the reference ----------------------
REFERENCE_REF = dt.date(2024, 12, 31)
REFERENCE_START = dt.date(2024, 1, 1)

CLIENT_COLUMNS = (
    "client_id", "date_inscription", "genre", "senior_citizen", "partenaire",
    "personnes_a_charge", "canal_acquisition", "region",
)


@dataclass(frozen=True)
class FeatureOptions:
    """Where the SQL and the script rules differ; defaults are the SQL rules."""

    tenure_mode: str = "calendar"         # "calendar" | "days30"
    keep_future: bool = False             # keep subscriptions starting after ref
    lookup: str = "inner"                 # "inner" (drop unknown product) | "left"
    pick: str = "row"                     # "row" (whole latest row) | "last_nonnull" (per column)
    no_contact_rate: float = 1.0          # resolution rate without any contact
    count_nulls: bool = True              # count rows (True) or rows with an amount / theme
    trend_form: str = "bands"             # "bands" (one pass) | "outer" (outer merges)


SCRIPT_OPTIONS = FeatureOptions(
    tenure_mode="days30", keep_future=True, lookup="left", pick="last_nonnull",
    no_contact_rate=0.0, count_nulls=False, trend_form="outer",
)


def subscription_features(
    tables: Mapping[str, DataFrame], ref: dt.date, options: FeatureOptions
) -> DataFrame:
    """Retained subscription per client with tenure and category."""
    abo = tables["abonnements"]
    cutoff = None if options.keep_future else ref
    if options.pick == "last_nonnull":
        cols = ["produit_id", "date_debut", "date_fin", "tarif_mensuel", "type_contrat", "statut"]
        if cutoff is not None:
            abo = abo.filter(F.col("date_debut") <= F.lit(cutoff))
        picked = last_nonnull(abo, "client_id", ["date_debut", "abonnement_id"], cols)
        prod = tables["produits"].select("produit_id", F.col("categorie").alias("categorie_produit"))
        latest = picked.join(prod, "produit_id", "inner" if options.lookup == "inner" else "left")
    else:
        latest = latest_subscription(abo, tables["produits"], cutoff, lookup=options.lookup)
    return with_tenure(latest, ref, options.tenure_mode).select(
        "client_id", "date_debut", "date_fin", "tarif_mensuel", "type_contrat", "statut",
        "categorie_produit", "tenure_mois",
    )


def build_features(
    tables: Mapping[str, DataFrame],
    ref: dt.date = REFERENCE_REF,
    start: dt.date = REFERENCE_START,
    options: FeatureOptions = FeatureOptions(),
    label_ids: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """The feature table: one row per client with a retained subscription.

    ``label_ids`` (a one-column ``client_id`` frame) switches the label to set
    membership; otherwise the label is "cancelled with an end date on or
    after the period start".  ``ordered`` adds the final ``ORDER BY
    client_id`` (a range shuffle); leave it off when writing partitioned
    output.
    """
    subs = subscription_features(tables, ref, options)
    billing = agg_billing(tables["facturation"], start, ref, options.count_nulls)
    support = agg_support(tables["interactions_support"], start, ref, options.count_nulls)
    if options.trend_form == "outer":
        usage = usage_trend_outer(tables["usage_mensuel"], start, ref)
    else:
        usage = usage_trend(tables["usage_mensuel"], start, ref, null_clients=False)

    clients = tables["clients"].select(*CLIENT_COLUMNS)
    joined = (
        clients.join(subs, "client_id")
        .join(billing, "client_id", "left")
        .join(support, "client_id", "left")
        .join(usage, "client_id", "left")
    )
    n_inv = F.coalesce(F.col("nb_factures"), F.lit(0))
    if options.trend_form == "outer":
        last3 = F.coalesce(F.col("connexions_moy_3derniers_mois"), F.lit(0.0))
        prev3 = F.coalesce(F.col("connexions_moy_3mois_avant"), F.lit(0.0))
        evolution = F.coalesce(F.col("evolution_connexions_ratio"), F.lit(0.0))
    else:
        last3 = F.coalesce(F.col("connexions_3derniers_mois"), F.lit(0.0))
        prev3 = F.coalesce(F.col("connexions_3mois_avant"), F.lit(0.0))
        evolution = relative_change(F.col("connexions_3derniers_mois"), F.col("connexions_3mois_avant"))
    # the script rule is 0.0: it zero-fills every gap before its fill with 1
    rate = F.coalesce(F.col("taux_resolution_satisfaisante"), F.lit(float(options.no_contact_rate)))

    out = joined.select(
        *CLIENT_COLUMNS,
        "tenure_mois",
        "type_contrat",
        F.col("tarif_mensuel").alias("charges_mensuelles"),
        "categorie_produit",
        n_inv.alias("nb_factures"),
        F.coalesce(F.col("total_charges"), F.lit(0).cast("decimal(20,2)")).alias("total_charges"),
        F.coalesce(F.col("nb_retards_paiement"), F.lit(0)).alias("nb_retards_paiement"),
        safe_ratio(F.col("nb_retards_paiement"), F.col("nb_factures")).alias("ratio_retards_paiement"),
        F.coalesce(F.col("nb_interactions_support"), F.lit(0)).alias("nb_interactions_support"),
        F.coalesce(F.col("nb_contacts_resiliation"), F.lit(0)).alias("nb_contacts_resiliation"),
        rate.alias("taux_resolution_support"),
        F.coalesce(F.col("total_connexions_12_mois"), F.lit(0)).alias("total_connexions_12_mois"),
        last3.alias("connexions_moy_3derniers_mois"),
        prev3.alias("connexions_moy_3mois_avant"),
        F.coalesce(F.col("total_volume_go_12_mois"), F.lit(0).cast("decimal(20,2)")).alias("total_volume_go_12_mois"),
        evolution.alias("evolution_connexions_ratio"),
        churn_flag(start).alias("churn"),
    )
    if label_ids is not None:
        out = membership_flag(out.drop("churn"), label_ids, "client_id", "churn")
    out = out.select(*EXPORT_COLUMNS)
    return out.orderBy("client_id") if ordered else out


def features_onerow(
    tables: Mapping[str, DataFrame],
    ref: dt.date = REFERENCE_REF,
    start: dt.date = REFERENCE_START,
    ordered: bool = True,
) -> DataFrame:
    """SQL profile: the 24 columns of the extraction query, in its order."""
    return build_features(tables, ref, start, ordered=False).select(*FEATURE_COLUMNS).transform(
        lambda df: df.orderBy("client_id") if ordered else df
    )


def export_profile(df: DataFrame, wanted=EXPORT_COLUMNS) -> DataFrame:
    """Ordered projection of the wanted columns that exist (export list)."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def features_script_variant(
    tables: Mapping[str, DataFrame],
    ref: dt.date = REFERENCE_REF,
    start: dt.date = REFERENCE_START,
    label_ids: DataFrame | None = None,
) -> DataFrame:
    """Script rules (30-day tenure, last non-null value per subscription
    column, left product lookup, future subscriptions kept, zero resolution
    rate without contact, outer-merge trend)."""
    return build_features(tables, ref, start, options=SCRIPT_OPTIONS, label_ids=label_ids)


__all__ = [
    "FeatureOptions", "SCRIPT_OPTIONS", "build_features", "features_onerow", "export_profile",
    "features_script_variant", "subscription_features",
]
