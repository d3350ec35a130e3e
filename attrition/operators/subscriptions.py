"""Subscription operators: latest subscription per client, tenure, label.

Ranking uses an explicit tie-break (``abonnement_id DESC``) so the pick is
deterministic when a client has two subscriptions starting the same day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.functions import calendar_months, flag, months_30day, same_text
from attrition.session import cut_lineage
from attrition.sources.schema import STATUS_CANCELLED

def latest_first():
    return F.col("date_debut").desc(), F.col("abonnement_id").desc()


def product_lookup(produits: DataFrame) -> DataFrame:
    return produits.select("produit_id", F.col("categorie").alias("categorie_produit"))


def latest_subscription(
    abonnements: DataFrame,
    produits: DataFrame,
    ref: dt.date | None,
    lookup: str = "inner",
) -> DataFrame:
    """Latest subscription per client that started on or before ``ref``
    (``ref=None``: no cut-off, future subscriptions compete too).

    ``lookup="inner"`` drops subscriptions whose product is unknown *before*
    ranking (the SQL rule).  ``lookup="left"`` ranks every subscription and
    attaches the category afterwards, null when unknown (script rule).

    Plan: the ``date_debut`` filter reaches the scan; ``row_number() = 1``
    becomes a partial ``WindowGroupLimit`` ahead of the shuffle, so a client
    with a huge subscription history still ships one row per map task.
    """
    w = Window.partitionBy("client_id").orderBy(*latest_first())
    subs = abonnements if ref is None else abonnements.filter(F.col("date_debut") <= F.lit(ref))
    if lookup == "inner":
        subs = subs.join(product_lookup(produits), "produit_id")
    ranked = subs.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1).drop("rn")
    if lookup == "left":
        ranked = ranked.join(product_lookup(produits), "produit_id", "left")
    elif lookup != "inner":
        raise ValueError(f"lookup must be 'inner' or 'left', got {lookup!r}")
    return ranked


def latest_rank_first(abonnements: DataFrame, produits: DataFrame, ref: dt.date) -> DataFrame:
    """Same pick as ``latest_subscription``, with the product looked up after ranking.

    Every client's newest subscription is ranked first (one row per client and map task moves) and only these
    rows meet ``produits``.  The rule drops subscriptions of unknown products, so clients whose
    newest one has none are an exception: their subscriptions alone, found by a semi join with
    those clients, take the other order.  For a ``produits`` too large to broadcast this moves one row per
    client by product instead of every subscription, for a second scan of the subscriptions and a checkpoint.
    """
    subs = abonnements.filter(F.col("date_debut") <= F.lit(ref))
    w = Window.partitionBy("client_id").orderBy(*latest_first())
    top = subs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    found = product_lookup(produits).withColumn("_known", F.lit(True))
    # materialised: read twice, and its size decides how the exceptions meet the subscriptions
    picked = cut_lineage(top.join(found, "produit_id", "left"))
    unknown = picked.filter(F.col("_known").isNull()).select(F.col("client_id").alias("_client"))
    rest = subs.join(unknown, F.col("client_id").eqNullSafe(F.col("_client")), "left_semi")
    return picked.filter("_known").drop("_known").unionByName(latest_subscription(rest, produits, ref))


def latest_by_maxby(abonnements: DataFrame, produits: DataFrame, ref: dt.date) -> DataFrame:
    """Same pick as ``latest_subscription`` written as one ``max_by`` aggregate.

    ``max_by(struct(row), struct(date_debut, abonnement_id))`` is a plain hash
    aggregate: partial per map task, so it is skew-proof without a sort.
    """
    subs = abonnements.filter(F.col("date_debut") <= F.lit(ref)).join(product_lookup(produits), "produit_id")
    cols = [c for c in subs.columns if c != "client_id"]
    best = F.max_by(F.struct(*cols), F.struct("date_debut", "abonnement_id")).alias("best")
    return subs.groupBy("client_id").agg(best).select("client_id", *[F.col(f"best.{c}").alias(c) for c in cols])


def last_nonnull(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per key, the last non-null value of each column in ``order``.

    ``sort_values(order).groupby(key).last()`` semantics: every column is
    picked independently (``max_by ... FILTER (WHERE c IS NOT NULL)``), so an
    old ``date_fin`` can survive next to a newer row's status.  One hash
    aggregate, partial per map task.
    """
    order_key = ", ".join(f"`{o}`" for o in order)
    aggs = [
        F.expr(f"max_by(`{c}`, struct({order_key})) FILTER (WHERE `{c}` IS NOT NULL)").alias(c)
        for c in columns
    ]
    return df.groupBy(key).agg(*aggs)


def with_tenure(latest: DataFrame, ref: dt.date, mode: str = "calendar") -> DataFrame:
    """Add ``tenure_mois`` for the retained subscription.

    ``calendar``: whole calendar months ``date_debut`` -> ``ref``.
    ``days30``: elapsed days // 30, clipped at 0.
    """
    if mode == "calendar":
        tenure = calendar_months(F.col("date_debut"), F.lit(ref))
    elif mode == "days30":
        tenure = months_30day(F.col("date_debut"), F.lit(ref))
    else:
        raise ValueError(f"mode must be 'calendar' or 'days30', got {mode!r}")
    return latest.withColumn("tenure_mois", tenure)


def churn_flag(start: dt.date):
    """``statut = 'résilié' AND date_fin >= start`` -> 1, else 0 (null end -> 0), however the accents are stored."""
    return flag(same_text(F.col("statut"), STATUS_CANCELLED) & (F.col("date_fin") >= F.lit(start)))
