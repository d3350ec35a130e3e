"""The feature table for a relation of reporting windows, every fact read once.

One row per (window, client), equal to :func:`attrition.plans.features.build_features` with the window's
``ref`` and ``start`` under the SQL rules.  Billing and support are sums by (client, segment)
(see :mod:`attrition.operators.windows`), then by (client, window).  Usage keeps, beside its sums, the six latest months
of each (client, segment): the latest six of a window are among those of its segments.

The latest subscription as of every window: a subscription first counts for the earliest reference date not before
its start, the largest one of each (client, reference date) is one aggregate, and it holds until the
client's next.  What is then ordered by client is bounded by the number of windows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.functions import calendar_months, flag, relative_change, safe_ratio, same_text
from attrition.operators.activity import BANDS, RECENT
from attrition.operators.subscriptions import product_lookup
from attrition.operators.windows import segment_windows, segments, to_windows, with_segment
from attrition.plans.features import CLIENT_COLUMNS
from attrition.session import cut_lineage
from attrition.sources.schema import EXPORT_COLUMNS, STATUS_CANCELLED, THEME_CANCELLATION

LATEST = RECENT * BANDS
SPREAD = 8      # tasks over which one client's usage of one segment is dealt


# Each theme in two steps: sums of facts by (client, segment), and sums of these by whatever holds the segments.
def billing_sums(rows: DataFrame) -> DataFrame:
    """client_id, segment, n, charged, late of invoices with their segment."""
    return rows.groupBy("client_id", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("montant").alias("charged"), F.count_if(F.col("paye_a_temps") == 0).alias("late"))


def billing_totals(sums: DataFrame) -> DataFrame:
    """window_id, client_id, nb_factures, total_charges, nb_retards_paiement."""
    return sums.groupBy("window_id", "client_id").agg(
        F.sum("n").alias("nb_factures"), F.sum("charged").cast("decimal(20,2)").alias("total_charges"),
        F.sum("late").alias("nb_retards_paiement"))


def support_sums(rows: DataFrame) -> DataFrame:
    """client_id, segment, n, leaving, good, rated of contacts with their segment."""
    return rows.groupBy("client_id", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(same_text(F.col("theme"), THEME_CANCELLATION)).alias("leaving"),
        F.sum(F.col("resolution_satisfaisante").cast("long")).alias("good"), F.count("resolution_satisfaisante").alias("rated"))


def support_totals(sums: DataFrame) -> DataFrame:
    """window_id, client_id, nb_interactions_support, nb_contacts_resiliation, taux_resolution_satisfaisante."""
    return sums.groupBy("window_id", "client_id").agg(
        F.sum("n").alias("nb_interactions_support"), F.sum("leaving").alias("nb_contacts_resiliation"),
        F.try_divide(F.sum("good").cast("double"), F.sum("rated")).alias("taux_resolution_satisfaisante"))


def _merged_usage(sums: DataFrame, *by: str) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.sum("connections").alias("connections"), F.sum("volume").alias("volume"),
        F.slice(F.sort_array(F.flatten(F.collect_list("latest")), asc=False), 1, LATEST).alias("latest"))


def usage_sums(rows: DataFrame) -> DataFrame:
    """client_id, segment, connections, volume and the latest months (LATEST at most, newest first) of usage with its segment."""
    spread = rows.filter(F.col("client_id").isNotNull()).withColumn("_spread", F.pmod(F.xxhash64("usage_id"), F.lit(SPREAD)))
    group = ["client_id", "segment", "_spread"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("mois").desc(), F.col("usage_id").desc()))
    month = F.struct("mois", "usage_id", "nb_connexions")
    # the list holds LATEST rows at most: collect_list leaves nulls out
    parts = spread.withColumn("_rank", rank).groupBy(*group).agg(
        F.sum("nb_connexions").alias("connections"), F.sum("volume_data_go").alias("volume"),
        F.collect_list(F.when(F.col("_rank") <= LATEST, month)).alias("latest"))
    return _merged_usage(parts, "client_id", "segment")


def usage_totals(sums: DataFrame) -> DataFrame:
    """window_id, client_id, connexions_3derniers_mois, connexions_3mois_avant, total_connexions_12_mois, total_volume_go_12_mois."""
    def band(first: int):
        part = F.filter(F.slice("latest", first, RECENT), lambda m: m["nb_connexions"].isNotNull())
        total = F.aggregate(part, F.lit(0).cast("long"), lambda a, m: a + m["nb_connexions"])
        return F.when(F.size(part) > 0, total.cast("double") / F.size(part))

    return _merged_usage(sums, "window_id", "client_id").select(
        "window_id", "client_id", band(1).alias("connexions_3derniers_mois"),
        band(RECENT + 1).alias("connexions_3mois_avant"), F.col("connections").alias("total_connexions_12_mois"),
        F.col("volume").cast("decimal(20,2)").alias("total_volume_go_12_mois"))


@dataclass(frozen=True)
class Theme:
    table: str
    date: str
    columns: tuple[str, ...]
    sums: Callable[[DataFrame], DataFrame]
    totals: Callable[[DataFrame], DataFrame]


THEMES = {
    "billing": Theme("facturation", "date_facture", ("client_id", "date_facture", "montant", "paye_a_temps"),
                     billing_sums, billing_totals),
    "support": Theme("interactions_support", "date_interaction",
                     ("client_id", "date_interaction", "theme", "resolution_satisfaisante"), support_sums, support_totals),
    "usage": Theme("usage_mensuel", "mois", ("client_id", "mois", "usage_id", "nb_connexions", "volume_data_go"),
                   usage_sums, usage_totals),
}


def subscriptions_asof(abonnements: DataFrame, produits: DataFrame, windows: DataFrame) -> DataFrame:
    """window_id, start, ref, client_id and the columns of the latest subscription that began by ``ref``."""
    refs = windows.select("ref").distinct()
    order = Window.orderBy("ref")
    numbered = refs.select("ref", (F.row_number().over(order) - 1).cast("long").alias("number"))
    # (reference date before, reference date] as segments of the starts; the first one reaches back to the beginning
    spans = numbered.select(F.col("number").alias("segment"),
                            F.coalesce(F.date_add(F.lag("ref").over(order), 1), F.trunc("ref", "MM")).alias("first"),
                            F.col("ref").alias("last"))
    earliest = F.trunc(F.lit(spans.agg(F.min("last")).first()[0]), "MM")    # one value; null without windows
    known = abonnements.join(product_lookup(produits), "produit_id").filter(F.col("client_id").isNotNull())
    dated = known.withColumn("_from", F.greatest("date_debut", earliest)).filter(F.col("date_debut").isNotNull())
    placed = with_segment(dated, "_from", spans).drop("_from")
    columns = ("date_debut", "date_fin", "tarif_mensuel", "type_contrat", "statut", "categorie_produit")
    best = placed.groupBy("client_id", "segment").agg(F.max_by(
        F.struct(*columns), F.struct("date_debut", "abonnement_id")).alias("sub"))
    following = F.lead("segment").over(Window.partitionBy("client_id").orderBy("segment"))
    last = F.lit(spans.agg(F.max("segment")).first()[0])
    held = best.withColumn("_to", F.coalesce(following - 1, last)).select(
        "client_id", "sub", F.explode(F.sequence("segment", "_to")).alias("segment"))
    members = windows.join(numbered, "ref").select(F.col("number").alias("segment"), "window_id")
    return to_windows(held, members).join(windows, "window_id").select(
        "window_id", "start", "ref", "client_id", *[F.col(f"sub.{c}").alias(c) for c in columns])


def features_asof(tables: Mapping[str, DataFrame], windows: DataFrame) -> DataFrame:
    """window_id, ref and the export columns, one row per window and client with a subscription by then.

    ``windows``: window_id (unique), start, ref.  Windows may overlap, repeat or leave gaps; one without facts
    still has its clients; no windows give no rows.
    """
    windows = cut_lineage(windows.select("window_id", "start", "ref"))      # read by every fact; as many rows as windows
    pieces = cut_lineage(segments(windows))
    members = cut_lineage(segment_windows(windows, pieces))
    sums = {name: t.sums(with_segment(tables[t.table].select(*t.columns), t.date, pieces)) for name, t in THEMES.items()}
    return assembled(tables, windows, members, sums)


def assembled(tables: Mapping[str, DataFrame], windows: DataFrame, members: DataFrame, sums: Mapping[str, DataFrame]) -> DataFrame:
    """The feature rows of every window from the sums of each theme by (client, segment) and the windows' segments."""
    joined = tables["clients"].select(*CLIENT_COLUMNS).join(
        subscriptions_asof(tables["abonnements"], tables["produits"], windows), "client_id")
    for name, theme in THEMES.items():
        joined = joined.join(theme.totals(to_windows(sums[name], members)), ["window_id", "client_id"], "left")
    zero = F.lit(0).cast("decimal(20,2)")
    out = joined.select(
        "window_id", "ref", *CLIENT_COLUMNS,
        calendar_months(F.col("date_debut"), F.col("ref")).alias("tenure_mois"),
        "type_contrat", F.col("tarif_mensuel").alias("charges_mensuelles"), "categorie_produit",
        F.coalesce("nb_factures", F.lit(0)).alias("nb_factures"),
        F.coalesce("total_charges", zero).alias("total_charges"),
        F.coalesce("nb_retards_paiement", F.lit(0)).alias("nb_retards_paiement"),
        safe_ratio(F.col("nb_retards_paiement"), F.col("nb_factures")).alias("ratio_retards_paiement"),
        F.coalesce("nb_interactions_support", F.lit(0)).alias("nb_interactions_support"),
        F.coalesce("nb_contacts_resiliation", F.lit(0)).alias("nb_contacts_resiliation"),
        F.coalesce("taux_resolution_satisfaisante", F.lit(1.0)).alias("taux_resolution_support"),
        F.coalesce("total_connexions_12_mois", F.lit(0)).alias("total_connexions_12_mois"),
        F.coalesce("connexions_3derniers_mois", F.lit(0.0)).alias("connexions_moy_3derniers_mois"),
        F.coalesce("connexions_3mois_avant", F.lit(0.0)).alias("connexions_moy_3mois_avant"),
        F.coalesce("total_volume_go_12_mois", zero).alias("total_volume_go_12_mois"),
        relative_change(F.col("connexions_3derniers_mois"), F.col("connexions_3mois_avant")).alias("evolution_connexions_ratio"),
        flag(same_text(F.col("statut"), STATUS_CANCELLED) & (F.col("date_fin") >= F.col("start"))).alias("churn"))
    return out.select("window_id", "ref", *EXPORT_COLUMNS)
