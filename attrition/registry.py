"""Registered queries: name -> Spark builder, plus its DuckDB oracle text.

Every builder reads the driver test tables of one scale-factor directory
through ``attrition.sources.testtables`` and returns a DataFrame whose work
section 2.  Each has an oracle text; that of the fitted model makes the same Newton steps in SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition import oracle
from attrition.functions import membership_flag, parse_date, relative_change, safe_ratio, same_text
from attrition.operators import activity, ingest, ml, quality, subscriptions
from attrition.operators.windows import month_end_windows, reporting_windows
from attrition.plans import features as feat
from attrition.plans import refresh, summary, training
from attrition.plans.features_asof import features_asof
from attrition.plans.features_sql import features_sql
from attrition.session import cut_lineage
from attrition.sources import catalogue as cat
from attrition.sources import files, store
from attrition.sources.schema import DOMAINS, EXPORT_COLUMNS, TABLES, contracts
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}

REF, START = TEST_REF, TEST_START
CONTRACTS = contracts(T.LongType())


def register(name: str, sql: str | None = None):
    def wrap(fn: Builder) -> Builder:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return wrap


def queries() -> dict[str, Builder]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return feat.build_features(load_tables(spark, sf), REF, START)


def _model_frame(spark: SparkSession, sf: str) -> DataFrame:
    return ml.model_frame(_features(spark, sf))


# ====================================================================== L8
@register("features_onerow", oracle.features_onerow())
def q_features_onerow(spark, sf):
    return feat.features_onerow(load_tables(spark, sf), REF, START, ordered=True)


@register("features_sql", oracle.features_onerow())
def q_features_sql(spark, sf):
    """The flagship as one Spark SQL text with named period parameters."""
    return features_sql(spark, load_tables(spark, sf), REF, START)


@register("export_profile", oracle.features_export())
def q_export_profile(spark, sf):
    return feat.export_profile(_features(spark, sf)).orderBy("client_id")


@register("features_asof", oracle.features_asof())
def q_features_asof(spark, sf):
    """The feature table at twelve month ends, every fact read once."""
    return features_asof(load_tables(spark, sf), month_end_windows(spark, REF, oracle.ASOF_WINDOWS))


@register("features_incremental", oracle.features_export())
def q_features_incremental(spark, sf):
    """The export features from a monthly state that was made for ten months and then for two more."""
    t = load_tables(spark, sf)
    path = files.shared_dir(spark, "state")
    refresh.update_months(t, path, START, dt.date(REF.year, 10, 31))
    for month in (11, 12):
        end = dt.date(REF.year, 11, 30) if month == 11 else REF
        refresh.update_months(t, path, dt.date(REF.year, month, 1), end)
    windows = reporting_windows(spark, [(0, START, REF)])
    return refresh.features_from_state(refresh.load_state(spark, path), t, windows).drop("window_id", "ref")


@register("features_script_variant", oracle.features_script_variant())
def q_features_script_variant(spark, sf):
    t = load_tables(spark, sf)
    # the script labels by membership in a set of client ids: here, those who ever cancelled in the period
    left = t["abonnements"].filter(same_text(F.col("statut"), "résilié") & (F.col("date_fin") >= F.lit(START)))
    return feat.features_script_variant(t, REF, START, label_ids=left.select("client_id"))


# ============================================================ A4 scans
def _scan(table: str) -> Builder:
    def build(spark, sf):
        return load_tables(spark, sf)[table]
    return build


for _t in TABLES:
    register(f"scan_{_t}", oracle.scan(_t))(_scan(_t))


# ================================================================ L1 / E / F
LATEST_COLS = ("client_id", "abonnement_id", "produit_id", "date_debut", "date_fin", "tarif_mensuel",
               "type_contrat", "statut", "categorie_produit")


@register("latest_rank_first", oracle.latest_rank_first())
def q_latest_rank_first(spark, sf):
    """Latest subscription where every fifth product is unknown: ranked first, looked up later."""
    t = load_tables(spark, sf)
    some = t["produits"].filter(F.col("produit_id") % 5 != 0)
    return subscriptions.latest_rank_first(t["abonnements"], some, REF).select(*LATEST_COLS)


@register("latest_subscription", oracle.latest_subscription())
def q_latest_subscription(spark, sf):
    t = load_tables(spark, sf)
    return subscriptions.latest_subscription(t["abonnements"], t["produits"], REF).select(*LATEST_COLS)


@register("latest_by_maxby", oracle.latest_subscription())
def q_latest_by_maxby(spark, sf):
    t = load_tables(spark, sf)
    return subscriptions.latest_by_maxby(t["abonnements"], t["produits"], REF).select(*LATEST_COLS)


@register("last_nonnull", oracle.last_nonnull())
def q_last_nonnull(spark, sf):
    abo = load_tables(spark, sf)["abonnements"].filter(F.col("date_debut") <= F.lit(REF))
    return subscriptions.last_nonnull(abo, "client_id", ["date_debut", "abonnement_id"],
                                      ["produit_id", "date_fin", "tarif_mensuel", "type_contrat", "statut"])


@register("tenure_calendar", oracle.tenure_calendar())
def q_tenure_calendar(spark, sf):
    t = load_tables(spark, sf)
    latest = subscriptions.latest_subscription(t["abonnements"], t["produits"], REF)
    return subscriptions.with_tenure(latest, REF, "calendar").select("client_id", "date_debut", "tenure_mois")


@register("tenure_days30", oracle.tenure_days30())
def q_tenure_days30(spark, sf):
    t = load_tables(spark, sf)
    latest = subscriptions.latest_subscription(t["abonnements"], t["produits"], None, lookup="left")
    return subscriptions.with_tenure(latest, REF, "days30").select("client_id", "date_debut", "tenure_mois")


@register("churn_label", oracle.churn_label())
def q_churn_label(spark, sf):
    t = load_tables(spark, sf)
    latest = subscriptions.latest_subscription(t["abonnements"], t["produits"], REF)
    return latest.select("client_id", "statut", "date_fin", subscriptions.churn_flag(START).alias("churn"))


# ====================================================== L2-L5 aggregates
@register("agg_billing", oracle.agg_billing())
def q_agg_billing(spark, sf):
    return activity.agg_billing(load_tables(spark, sf)["facturation"], START, REF)


@register("param_window", oracle.agg_billing())
def q_param_window(spark, sf):
    """The parameter relation as named SQL parameters, not a cross join."""
    fact = load_tables(spark, sf)["facturation"]
    return spark.sql(
        """
        SELECT client_id,
               COUNT(*) AS nb_factures,
               SUM(montant) AS total_charges,
               CASE WHEN COUNT(montant) > 0 THEN CAST(SUM(montant) AS DOUBLE) / COUNT(montant) END
                 AS montant_moyen_facture,
               COUNT_IF(paye_a_temps = 0) AS nb_retards_paiement,
               COUNT_IF(paye_a_temps = 1) AS nb_paiements_a_temps
        FROM {facturation}
        WHERE date_facture BETWEEN :debut_periode AND :date_reference
        GROUP BY client_id
        """,
        args={"debut_periode": START, "date_reference": REF},
        facturation=fact,
    )


@register("agg_support", oracle.agg_support())
def q_agg_support(spark, sf):
    return activity.agg_support(load_tables(spark, sf)["interactions_support"], START, REF)


@register("usage_ranked", oracle.usage_ranked())
def q_usage_ranked(spark, sf):
    u = activity.usage_ranked(load_tables(spark, sf)["usage_mensuel"], START, REF)
    return u.select("client_id", "mois", "usage_id", "nb_connexions", "volume_data_go", "duree_appels_min",
                    "rn_mois")


@register("usage_trend", oracle.usage_trend())
def q_usage_trend(spark, sf):
    u = activity.usage_trend(load_tables(spark, sf)["usage_mensuel"], START, REF)
    return u.withColumn(
        "evolution_connexions_ratio",
        relative_change(F.col("connexions_3derniers_mois"), F.col("connexions_3mois_avant")),
    )


@register("agg_usage_totals", oracle.agg_usage_totals())
def q_agg_usage_totals(spark, sf):
    return activity.usage_totals(load_tables(spark, sf)["usage_mensuel"], START, REF)


@register("reverse_rank", oracle.reverse_rank())
def q_reverse_rank(spark, sf):
    return activity.reverse_rank(load_tables(spark, sf)["usage_mensuel"], START, REF)


@register("usage_trend_outer", oracle.usage_trend_outer())
def q_usage_trend_outer(spark, sf):
    return activity.usage_trend_outer(load_tables(spark, sf)["usage_mensuel"], START, REF)


# ============================================================ B filters
@register("filter_period", oracle.filter_period())
def q_filter_period(spark, sf):
    f = load_tables(spark, sf)["facturation"]
    return f.filter(F.col("date_facture").between(F.lit(START), F.lit(REF))).select(
        "facture_id", "client_id", "date_facture", "montant", "paye_a_temps")


@register("late_ratio", oracle.late_ratio())
def q_late_ratio(spark, sf):
    t = load_tables(spark, sf)
    billing = activity.agg_billing(t["facturation"], START, REF)
    j = t["clients"].select("client_id").join(billing, "client_id", "left")
    return j.select(
        "client_id",
        F.coalesce("nb_factures", F.lit(0)).alias("nb_factures"),
        F.coalesce("nb_retards_paiement", F.lit(0)).alias("nb_retards_paiement"),
        safe_ratio(F.col("nb_retards_paiement"), F.col("nb_factures")).alias("ratio_retards_paiement"),
    )


@register("membership_flag", oracle.membership_flag())
def q_membership_flag(spark, sf):
    t = load_tables(spark, sf)
    ids = t["interactions_support"].filter(same_text(F.col("theme"), "résiliation")).select("client_id")
    return membership_flag(t["clients"].select("client_id"), ids, "client_id", "in_set")


@register("parse_dates", oracle.parse_dates())
def q_parse_dates(spark, sf):
    abo = load_tables(spark, sf)["abonnements"]
    text = F.date_format("date_debut", "yyyy-MM-dd")
    return abo.select("abonnement_id", text.alias("date_text"), parse_date(text).alias("date_parsed"))


# ================================================================= C joins
@register("join_inner_dim", oracle.join_inner_dim())
def q_join_inner_dim(spark, sf):
    t = load_tables(spark, sf)
    return t["abonnements"].join(t["produits"].select("produit_id", "categorie"), "produit_id").select(
        "abonnement_id", "client_id", "produit_id", "categorie")


@register("join_left_lookup", oracle.join_left_lookup())
def q_join_left_lookup(spark, sf):
    t = load_tables(spark, sf)
    return t["abonnements"].join(t["produits"].select("produit_id", "categorie"), "produit_id", "left").select(
        "abonnement_id", "client_id", "produit_id", "categorie")


@register("join_inner_client", oracle.join_inner_client())
def q_join_inner_client(spark, sf):
    t = load_tables(spark, sf)
    subs = feat.subscription_features(t, REF, feat.FeatureOptions())
    return t["clients"].join(subs, "client_id").select(
        "client_id", "genre", "region", "type_contrat", "categorie_produit", "tenure_mois")


@register("join_left_aggs", oracle.join_left_aggs())
def q_join_left_aggs(spark, sf):
    t = load_tables(spark, sf)
    billing = activity.agg_billing(t["facturation"], START, REF)
    support = activity.agg_support(t["interactions_support"], START, REF)
    usage = activity.usage_totals(t["usage_mensuel"], START, REF)
    return (
        t["clients"].select("client_id")
        .join(billing, "client_id", "left")
        .join(support, "client_id", "left")
        .join(usage, "client_id", "left")
        .select("client_id", "nb_factures", "total_charges", "nb_interactions_support",
                "total_connexions_12_mois")
    )


# ============================================================ A sources/sinks
@register("csv_roundtrip", oracle.features_export())
def q_csv_roundtrip(spark, sf):
    """Export the 25-column dataset as CSV into the shared folder, read it back typed."""
    df = feat.export_profile(_features(spark, sf))
    path = files.write_csv(df, files.shared_dir(spark, "exports"))
    return files.read_csv(spark, path, df.schema)


@register("csv_multiline", oracle.csv_multiline())
def q_csv_multiline(spark, sf):
    """Texts with newlines, quotes and commas written as CSV and read back by byte ranges."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    note = F.concat(F.lit('"'), F.col("source"), F.lit('", '), F.col("text"))
    df = docs.select("doc_id", "lang", note.alias("note"))
    back = files.read_csv(spark, files.write_csv(df, files.shared_dir(spark, "exports")), df.schema)
    return back.select("doc_id", "lang", F.length("note").cast("long").alias("n_chars"), F.md5("note").alias("note_md5"))


@register("dataset_summary", oracle.dataset_summary())
def q_dataset_summary(spark, sf):
    return summary.dataset_summary(_features(spark, sf))


@register("inline_catalogue", oracle.inline_catalogue(cat.CATALOGUE))
def q_inline_catalogue(spark, sf):
    t = load_tables(spark, sf)
    # counts per product first: a hot product is one row per map task before the join
    per_product = t["abonnements"].groupBy("produit_id").agg(F.count(F.lit(1)).alias("n"))
    per_cat = per_product.join(t["produits"], "produit_id").groupBy("categorie").agg(F.sum("n").alias("n_abonnements"))
    offers = cat.catalogue(spark).select(
        "categorie", F.col("produit_id").alias("offre_id"), F.col("nom").alias("offre"), "tarif_base")
    # the catalogue is four fixed rows: a bounded broadcast
    return per_cat.join(F.broadcast(offers), "categorie").select(
        "categorie", "offre_id", "offre", "tarif_base", "n_abonnements")


# ============================================================== A6-A11 quality
PRIMARY_KEYS = {c.name: c.primary_key for c in CONTRACTS.values()}
FOREIGN_KEYS = [(c.name, col, parent, pkey) for c in CONTRACTS.values()
                for col, (parent, pkey) in c.foreign_keys.items()]
NOT_NULL = [(c.name, col) for c in CONTRACTS.values() for col in c.not_null]


def _domain_rule_list():
    rules = []
    for c in CONTRACTS.values():
        for (table, column), allowed in DOMAINS.items():
            if table == c.name:
                rules.append((table, column, "domain", allowed))
        for column, n in c.max_length.items():
            rules.append((c.name, column, f"length<={n}", n))
    return rules


@register("dq_unique", oracle.dq_unique(PRIMARY_KEYS))
def q_dq_unique(spark, sf):
    t = load_tables(spark, sf)
    parts = [quality.dq_unique(t[name], name, key) for name, key in PRIMARY_KEYS.items()]
    return _union(parts)


@register("dq_orphans", oracle.dq_orphans(FOREIGN_KEYS))
def q_dq_orphans(spark, sf):
    t = load_tables(spark, sf)
    parts = [quality.dq_orphans(t[table], table, col, t[parent], parent, pkey)
             for table, col, parent, pkey in FOREIGN_KEYS]
    return _union(parts)


@register("dq_nulls", oracle.dq_nulls(NOT_NULL))
def q_dq_nulls(spark, sf):
    t = load_tables(spark, sf)
    parts = [quality.dq_nulls(t[c.name], c.name, c.not_null) for c in CONTRACTS.values()]
    return _union(parts)


@register("dq_domain", oracle.dq_domain(_domain_rule_list()))
def q_dq_domain(spark, sf):
    t = load_tables(spark, sf)
    parts = [quality.dq_domain(t[c.name], c) for c in CONTRACTS.values()]
    return _union(parts)


def _decomposed(df: DataFrame, key: str, column: str) -> DataFrame:
    """Every other row's accents as combining signs, every eleventh value null."""
    text = F.when(F.col(key) % 2 == 0, F.replace(column, F.lit("é"), F.lit("e\u0301"))).otherwise(F.col(column))
    return df.withColumn(column, F.when(F.col(key) % 11 != 0, text))


@register("features_accent_forms", oracle.features_accent_forms())
def q_features_accent_forms(spark, sf):
    """The export features where half the accents of statuses and themes are stored decomposed and some values are null."""
    t = dict(load_tables(spark, sf))
    t["abonnements"] = _decomposed(t["abonnements"], "abonnement_id", "statut")
    t["interactions_support"] = _decomposed(t["interactions_support"], "interaction_id", "theme")
    return feat.build_features(t, REF, START)


@register("ingest_spelling", oracle.ingest_spelling())
def q_ingest_spelling(spark, sf):
    """Values of a domain take one spelling when a feed is conformed to its table."""
    feed = _decomposed(load_tables(spark, sf)["abonnements"], "abonnement_id", "statut")
    return quality.conform(feed, CONTRACTS["abonnements"]).select("abonnement_id", "statut")


@register("ingest_quarantine", oracle.ingest_quarantine())
def q_ingest_quarantine(spark, sf):
    """A faulty feed written in one pass: valid rows, and rejected ones by reason."""
    t = load_tables(spark, sf)
    key = F.col("abonnement_id")
    faulty = quality.conform(t["abonnements"], CONTRACTS["abonnements"]).drop("created_at").withColumns({
        "client_id": F.when(key % 70 == 0, -F.col("client_id")).otherwise(F.col("client_id")),
        "produit_id": F.when(key % 83 != 0, F.col("produit_id")),
        "date_debut": F.when(key % 61 != 0, F.col("date_debut")),
        "statut": F.when(key % 50 == 0, F.lit("inconnu")).otherwise(F.col("statut"))})
    feed = faulty.unionByName(faulty.filter(key % 97 == 0))
    done = ingest.write_checked(feed, CONTRACTS["abonnements"], files.shared_dir(spark, "ingest"), t)
    found = done.rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return found.unionByName(done.valid.select(F.lit("valid").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


@register("ingest_insert", oracle.ingest_defaults())
def q_ingest_insert(spark, sf):
    """The same feed through a catalogue table with DEFAULT clauses and an INSERT that names four columns."""
    feed = load_tables(spark, sf)["usage_mensuel"].select("usage_id", "client_id", "mois", "nb_connexions")
    with store.catalogue_tables(spark, {"usage_mensuel": CONTRACTS["usage_mensuel"]}, partitioned=False) as tables:
        tables.insert("usage_mensuel", feed)
        return tables.stored("usage_mensuel").drop("created_at")


@register("ingest_defaults", oracle.ingest_defaults())
def q_ingest_defaults(spark, sf):
    """A usage feed that omits volume and call minutes: column defaults fill them."""
    feed = load_tables(spark, sf)["usage_mensuel"].select("usage_id", "client_id", "mois", "nb_connexions")
    return quality.conform(feed, CONTRACTS["usage_mensuel"]).drop("created_at")


@register("surrogate_key", oracle.surrogate_key())
def q_surrogate_key(spark, sf):
    f = load_tables(spark, sf)["facturation"].select(
        "facture_id", "client_id", "date_facture", "montant", "paye_a_temps")
    keyed = quality.surrogate_key(f, ["facture_id", "client_id", "date_facture", "montant", "paye_a_temps"])
    return keyed.select("surrogate_id", "facture_id", "client_id", "date_facture", "montant")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ==================================================================== K model
@register("model_frame", oracle.model_frame())
def q_model_frame(spark, sf):
    return _model_frame(spark, sf)


@register("category_vocab", oracle.category_vocab())
def q_category_vocab(spark, sf):
    frame = _model_frame(spark, sf)
    return ml.category_vocab(frame, ml.column_roles(frame, drop=(ml.KEY, ml.LABEL)).categorical)


@register("one_hot_columns", oracle.one_hot_columns())
def q_one_hot_columns(spark, sf):
    # two passes over the frame (vocabulary, then values): materialize it once
    frame = cut_lineage(_model_frame(spark, sf))
    return ml.one_hot_slots(frame, ml.column_roles(frame, drop=(ml.KEY, ml.LABEL)))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    # the split reads its frame twice (bucket sizes, then ranks): materialize
    # the one-row-per-client frame once instead of running the feature plan twice
    return ml.stratified_split(cut_lineage(_model_frame(spark, sf)))


@register("stratified_split", oracle.stratified_split())
def q_stratified_split(spark, sf):
    return _split(spark, sf).select("client_id", "label", "split")


@register("split_summary", oracle.split_summary())
def q_split_summary(spark, sf):
    return summary.split_summary(_split(spark, sf))


@register("class_weights", oracle.class_weights())
def q_class_weights(spark, sf):
    return ml.class_weights(_split(spark, sf).filter("split = 'train'"))


@register("score_linear", oracle.score_linear(ml.FIXED_SCORE))
def q_score_linear(spark, sf):
    return ml.score_linear(_model_frame(spark, sf)).drop("probability")


@register("accuracy", oracle.accuracy(ml.FIXED_SCORE))
def q_accuracy(spark, sf):
    return ml.accuracy(ml.score_linear(_model_frame(spark, sf)))


@register("confusion_matrix", oracle.confusion_matrix(ml.FIXED_SCORE))
def q_confusion_matrix(spark, sf):
    return ml.confusion_counts(ml.score_linear(_model_frame(spark, sf)))


@register("classification_report", oracle.classification_report(ml.FIXED_SCORE))
def q_classification_report(spark, sf):
    return ml.classification_report(ml.confusion_counts(ml.score_linear(_model_frame(spark, sf))))


@register("feature_vector", oracle.feature_vector())
def q_feature_vector(spark, sf):
    # two passes over the frame (indexer fit, then transform): materialize it once
    frame = cut_lineage(_model_frame(spark, sf))
    roles = ml.column_roles(frame, drop=(ml.KEY, ml.LABEL))
    assembled = ml.feature_pipeline(roles).fit(frame).transform(frame)
    from pyspark.ml.functions import vector_to_array
    return assembled.select(ml.KEY, ml.LABEL, vector_to_array("features").alias("features"))


# Newton steps end at the optimum itself, so SQL that makes the same steps gives the same numbers.
@register("train_lr", oracle.train_lr())
def q_train_lr(spark, sf):
    """Terms of the fitted model: each coefficient at the largest value its column has in training.

    In the driver tables a client's charges and data volume are the same numbers, so only the sum of the two
    coefficients is determined to the digits shown; both terms show it.
    """
    terms = training.train_newton(_features(spark, sf)).terms
    same = F.when(F.col("term").isin(*oracle.EQUAL_COLUMNS), F.lit("both")).otherwise(F.col("term"))
    return terms.select("term", "slot", F.round(F.sum("effect").over(Window.partitionBy(same)), 6).alias("effect"))


@register("predict_lr", oracle.predict_lr())
def q_predict_lr(spark, sf):
    """Held-out rows with probability and class."""
    scored = training.train_newton(_features(spark, sf)).predictions
    return scored.select(ml.KEY, ml.LABEL, F.round("probability", 6).alias("probability"), "prediction")


@register("predict_lbfgs", oracle.predict_lbfgs())
def q_predict_lbfgs(spark, sf):
    """Held-out rows with the class that Spark ML's own solver gives."""
    return training.train_and_evaluate(_features(spark, sf)).predictions.select(ml.KEY, ml.LABEL, "prediction")


@register("evaluate_lr", oracle.evaluate_lr())
def q_evaluate_lr(spark, sf):
    """The report of the held-out rows."""
    return training.train_newton(_features(spark, sf)).report


@register("model_roundtrip", oracle.model_roundtrip())
def q_model_roundtrip(spark, sf):
    """Held-out rows with the class and the probability of the saved and reread model."""
    result = training.train_newton(_features(spark, sf))
    path = training.save_model(result.model, files.shared_dir(spark, "models"))
    again = training.load_model(path).transform(result.split.filter("split = 'test'"))
    return again.groupBy(ml.LABEL, "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("probability"), 6).alias("mean_probability"))


__all__ = ["queries", "oracle_sql", "register", "EXPORT_COLUMNS"]
