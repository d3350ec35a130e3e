"""Per-client activity aggregates: billing, support, usage.

Each fact is filtered to the reporting period (the ``BETWEEN`` reaches the
parquet scan) and reduced to one row per client *before* any join, so the
final assembly joins four one-row-per-client relations.  All reductions are
hash aggregates with a map-side partial step: a client holding a third of
all rows costs one partial row per map task, not one giant task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.functions import exact_avg, in_period, relative_change, same_text
from attrition.operators.ranking import ordered_position
from attrition.sources.schema import THEME_CANCELLATION

RECENT = 3      # months in the "last" band
BANDS = 2       # last band + previous band


def agg_billing(facturation: DataFrame, start: dt.date, ref: dt.date, count_nulls: bool = True) -> DataFrame:
    """Invoices in the period: count, total, mean, late and on-time counts.

    ``count_nulls=False`` counts invoices with an amount only (script rule).
    Money is summed as exact decimal; the mean is ``sum / count`` in double
    (skips null amounts like ``AVG``).
    """
    f = facturation.filter(in_period(F.col("date_facture"), start, ref))
    return f.groupBy("client_id").agg(
        F.count(F.lit(1) if count_nulls else F.col("montant")).alias("nb_factures"),
        F.sum("montant").alias("total_charges"),
        exact_avg(F.col("montant")).alias("montant_moyen_facture"),
        F.count_if(F.col("paye_a_temps") == 0).alias("nb_retards_paiement"),
        F.count_if(F.col("paye_a_temps") == 1).alias("nb_paiements_a_temps"),
    )


def agg_support(interactions: DataFrame, start: dt.date, ref: dt.date, count_nulls: bool = True) -> DataFrame:
    """Support contacts in the period: count, cancellation contacts, resolution rate.

    ``count_nulls=False`` counts contacts with a theme only (script rule).
    """
    i = interactions.filter(in_period(F.col("date_interaction"), start, ref))
    return i.groupBy("client_id").agg(
        F.count(F.lit(1) if count_nulls else F.col("theme")).alias("nb_interactions_support"),
        F.count_if(same_text(F.col("theme"), THEME_CANCELLATION)).alias("nb_contacts_resiliation"),
        F.avg("resolution_satisfaisante").alias("taux_resolution_satisfaisante"),
    )


def _month_rank(order: str = "desc") -> Window:
    o = (F.col("mois").desc(), F.col("usage_id").desc()) if order == "desc" else (
        F.col("mois").asc(), F.col("usage_id").asc())
    return Window.partitionBy("client_id").orderBy(*o)


def usage_ranked(usage: DataFrame, start: dt.date, ref: dt.date, limit: int | None = None) -> DataFrame:
    """Usage rows in the period with ``rn_mois`` = 1 for the most recent month.

    With ``limit`` only ranks up to ``limit`` are kept: ``row_number() <=
    limit`` becomes a partial top-k (``WindowGroupLimit``) before the shuffle,
    so at most ``limit`` rows per client and map task move.  Without a limit
    every row keeps its rank, computed by ``ordered_position`` so that a
    client holding a third of all rows is spread over many tasks.
    """
    u = usage.filter(in_period(F.col("mois"), start, ref))
    if limit is None:
        ranked = ordered_position(u, [F.col("mois").desc(), F.col("usage_id").desc()],
                                  group=["client_id"], name="rn_mois")
        return ranked.withColumn("rn_mois", (F.col("rn_mois") + 1).cast("int"))
    return u.withColumn("rn_mois", F.row_number().over(_month_rank("desc"))).filter(F.col("rn_mois") <= limit)


def usage_totals(usage: DataFrame, start: dt.date, ref: dt.date) -> DataFrame:
    """Usage sums of the period per client: one scan, one aggregate, no ranking."""
    return usage.filter(in_period(F.col("mois"), start, ref)).groupBy("client_id").agg(
        F.sum("nb_connexions").alias("total_connexions_12_mois"),
        F.sum("volume_data_go").cast("decimal(20,2)").alias("total_volume_go_12_mois"),
    )


def usage_trend(usage: DataFrame, start: dt.date, ref: dt.date, null_clients: bool = True) -> DataFrame:
    """Usage totals and last-3 versus previous-3 month averages per client.

    Two reductions of the same filtered scan, joined on ``client_id``:
    * totals: plain partial + final hash aggregate over every row;
    * bands: ``row_number() <= 6`` (partial top-6 per map task, so at most six
      rows per client and task cross the shuffle) then conditional averages.
    Both come out hash-partitioned on ``client_id``, so the join between them
    adds no exchange.  Every client with a row has rank 1, so the join is 1:1.
    ``null_clients=False`` leaves out usage without a client (what a join to
    the clients drops anyway) and keeps the output partitioned on the plain key.
    """
    if not null_clients:
        usage = usage.filter(F.col("client_id").isNotNull())
    totals = usage_totals(usage, start, ref)
    rn = F.col("rn_mois")
    last = rn <= RECENT
    prev = (rn > RECENT) & (rn <= RECENT * BANDS)
    bands = usage_ranked(usage, start, ref, limit=RECENT * BANDS).groupBy("client_id").agg(
        F.avg(F.when(last, F.col("nb_connexions"))).alias("connexions_3derniers_mois"),
        F.avg(F.when(prev, F.col("nb_connexions"))).alias("connexions_3mois_avant"),
        exact_avg(F.when(last, F.col("volume_data_go"))).alias("volume_go_3derniers_mois"),
    )
    if not null_clients:
        return totals.join(bands, "client_id")
    # null-safe: usage without a client is one group of its own on both sides
    bands = bands.withColumnRenamed("client_id", "_client")
    return totals.join(bands, F.col("client_id").eqNullSafe(F.col("_client"))).drop("_client")


def reverse_rank(usage: DataFrame, start: dt.date, ref: dt.date) -> DataFrame:
    """0-based position in month order, its per-client maximum and the reverse position.

    ``rn`` = position in (``mois``, ``usage_id``) order starting at 0;
    ``rn_max`` = the client's largest position; ``reverse_rn`` = ``rn_max -
    rn`` (0 for the latest month).  The positions come from
    ``ordered_position``, so a client (or a single client-month) holding a
    third of all rows is spread over many tasks instead of one.
    """
    u = usage.filter(in_period(F.col("mois"), start, ref)).select(
        "client_id", "mois", "usage_id", "nb_connexions")
    ranked = ordered_position(u, ["mois", "usage_id"], group=["client_id"], name="rn", group_size="_n")
    return ranked.select(
        "client_id", "mois", "usage_id", "nb_connexions", "rn",
        (F.col("_n") - 1).alias("rn_max"),
        (F.col("_n") - 1 - F.col("rn")).alias("reverse_rn"),
    )


def usage_trend_outer(usage: DataFrame, start: dt.date, ref: dt.date) -> DataFrame:
    """Script form of the trend: band averages from the reverse position,
    full outer merges, zero fill.  Equal to ``usage_trend`` (the previous
    band's clients are a subset of the last band's); kept as its own operator.

    Only reverse positions below 6 are used, and ``reverse_rn < k`` is "among
    the k latest in (``mois``, ``usage_id``) order".  So the positions come
    from the partial top-6 of ``usage_ranked`` (``reverse_rn = rn_mois - 1``)
    rather than from the full ``reverse_rank``.  No range shuffle or
    checkpoint of the whole usage table is needed.
    """
    usage = usage.filter(F.col("client_id").isNotNull())   # the script's grouping drops null keys
    ranked = usage_ranked(usage, start, ref, limit=RECENT * BANDS)
    rr = F.col("rn_mois") - 1
    # both bands from one aggregate of the top rows; a missing band is a null average
    bands = ranked.groupBy("client_id").agg(
        F.avg(F.when(rr < RECENT, F.col("nb_connexions"))).alias("_last"),
        F.avg(F.when(rr >= RECENT, F.col("nb_connexions"))).alias("_prev"))
    merged = bands.join(usage_totals(usage, start, ref), "client_id", "full")
    filled = merged.select(
        "client_id",
        F.coalesce("_last", F.lit(0.0)).alias("connexions_moy_3derniers_mois"),
        F.coalesce("_prev", F.lit(0.0)).alias("connexions_moy_3mois_avant"),
        F.coalesce("total_connexions_12_mois", F.lit(0)).alias("total_connexions_12_mois"),
        F.coalesce("total_volume_go_12_mois", F.lit(0)).alias("total_volume_go_12_mois"),
    )
    return filled.withColumn(
        "evolution_connexions_ratio",
        relative_change(F.col("connexions_moy_3derniers_mois"), F.col("connexions_moy_3mois_avant")),
    )
