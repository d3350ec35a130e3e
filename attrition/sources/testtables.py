"""Driver test tables -> the six source tables.

The driver ships TPC-H-like parquet (``customer``, ``orders``, ``lineitem``,
``part``, ``events`` ...).  This module derives the six source tables of the
attrition model from them, lazily, as plain DataFrame projections, joins and
one aggregation each.  The same derivation is written as DuckDB SQL in
``ORACLE_CTES`` so the oracle sees word-for-word the same inputs.

Scale notes
-----------
* ``nation`` / ``region`` have 25 / 5 rows at every scale factor (fixed by
  the TPC-H specification), so they are broadcast by hint.
* ``part`` grows with the data: it is never broadcast by hint; the
  optimizer decides from its size (``autoBroadcastJoinThreshold``, re-checked
  at runtime by AQE) and falls back to a sort-merge join.
* ``lineitem`` is only ever touched through pruned projections and, where a
  date window applies, a pushed-down ``l_shipdate`` filter.
* ``load_tables`` returns a lazy mapping: a source table is derived only when
  a query asks for it, and each driver table is read (its files listed, its
  footers read) once per mapping, however many source tables use it.  On a
  cluster, listing a large fact table is itself a distributed job; doing it
  once per plan instead of once per use keeps planning time flat.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.schema import MONEY, STATUS_ACTIVE, STATUS_CANCELLED, THEME_CANCELLATION

# --- fixed values: parameters of the test-table mapping -------------------
# reporting window applied to the driver test tables (orders span
# 1995-01-01 .. 2001-08-01, so both bounds filter)
TEST_REF = dt.date(2000, 12, 31)
TEST_START = dt.date(2000, 1, 1)
SIGNUP_ORIGIN = dt.date(1994, 1, 1)
SUPPORT_ORIGIN = dt.date(1999, 12, 1)

SOURCE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


Reader = Callable[[str], DataFrame]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(c: Column) -> Column:
    # test timestamps load as timestamp_ntz: cast to DATE at ingest
    return c.cast("date")


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def clients(raw: Reader) -> DataFrame:
    customer = raw("customer")
    nation = raw("nation").select("n_nationkey", "n_regionkey")
    region = raw("region").select("r_regionkey", "r_name")
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    key = F.col("c_custkey")
    signup = F.date_add(F.lit(SIGNUP_ORIGIN), (key % 365).cast("int"))
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey).select(
        key.alias("client_id"),
        signup.alias("date_inscription"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("genre"),
        F.when(key % 6 == 0, 1).otherwise(0).cast("short").alias("senior_citizen"),
        F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("partenaire"),
        F.when(key % 3 == 0, "Yes").otherwise("No").alias("personnes_a_charge"),
        F.col("c_mktsegment").alias("canal_acquisition"),
        F.col("r_name").alias("region"),
        signup.cast("timestamp_ntz").alias("created_at"),
    )


def produits(raw: Reader) -> DataFrame:
    part = raw("part")
    family = F.substring_index(F.col("p_type"), " ", 1)
    return part.select(
        F.col("p_partkey").alias("produit_id"),
        F.col("p_name").alias("nom"),
        F.when(family.isin("ECONOMY", "STANDARD"), "Internet")
        .when(family.isin("MEDIUM", "SMALL"), "Mobile")
        .otherwise("Bundle")
        .alias("categorie"),
        _money(F.col("p_retailprice")).alias("tarif_base"),
    )


def abonnements(raw: Reader) -> DataFrame:
    orders = raw("orders")
    # one product per order: the smallest part key of its lines (partial
    # aggregate map-side, then one shuffle on l_orderkey)
    first_part = (
        raw("lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("produit_id"))
    )
    key = F.col("o_orderkey")
    start = _day(F.col("o_orderdate"))
    cancelled = F.col("o_orderstatus") == "F"
    priority = F.substring(F.col("o_orderpriority"), 1, 1)
    return orders.join(first_part, orders.o_orderkey == first_part.l_orderkey, "left").select(
        key.alias("abonnement_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("produit_id"),
        start.alias("date_debut"),
        F.when(cancelled, F.date_add(start, (key % 720).cast("int"))).alias("date_fin"),
        _money(F.col("o_totalprice")).alias("tarif_mensuel"),
        F.when(priority.isin("1", "2"), "Mensuel").when(priority == "3", "1_an").otherwise("2_ans")
        .alias("type_contrat"),
        F.when(key % 2 == 0, "Yes").otherwise("No").alias("facturation_sans_papier"),
        F.when(key % 4 == 0, "CB").when(key % 4 == 1, "Virement").when(key % 4 == 2, "Prélèvement")
        .otherwise("Chèque").alias("mode_paiement"),
        F.when(cancelled, STATUS_CANCELLED).otherwise(STATUS_ACTIVE).alias("statut"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
    )


def _order_lines(raw: Reader) -> DataFrame:
    lineitem = raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = raw("orders").select("o_orderkey", "o_custkey")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)


def facturation(raw: Reader) -> DataFrame:
    day = _day(F.col("l_shipdate"))
    late = F.col("l_returnflag") == "R"
    return _order_lines(raw).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("facture_id"),
        F.col("o_custkey").alias("client_id"),
        day.alias("date_facture"),
        _money(F.col("l_extendedprice")).alias("montant"),
        F.when(late, 0).otherwise(1).cast("short").alias("paye_a_temps"),
        F.date_add(day, F.when(late, 45).otherwise(7)).alias("date_paiement"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"),
    )


def interactions_support(raw: Reader) -> DataFrame:
    events = raw("events")
    key = F.col("event_id")
    kind = F.col("event_type")
    return events.select(
        key.alias("interaction_id"),
        F.col("user_id").alias("client_id"),
        F.date_add(F.lit(SUPPORT_ORIGIN), (F.dayofmonth("ts") - 1) * 15).alias("date_interaction"),
        F.when(key % 3 == 0, "appel").when(key % 3 == 1, "ticket").otherwise("chat").alias("type_interaction"),
        F.when(kind == "error", THEME_CANCELLATION).when(kind == "purchase", "facturation")
        .otherwise("technique").alias("theme"),
        F.when(F.col("value") < 75, 1).otherwise(0).cast("short").alias("resolution_satisfaisante"),
        F.col("ts").cast("timestamp_ntz").alias("created_at"),
    )


def usage_mensuel(raw: Reader) -> DataFrame:
    month = F.trunc(_day(F.col("l_shipdate")), "month")
    monthly = (
        _order_lines(raw)
        .groupBy(F.col("o_custkey").alias("client_id"), month.alias("mois"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum(_money(F.col("l_extendedprice"))).alias("volume"),
            F.count("*").alias("n_lines"),
        )
    )
    return monthly.select(
        (F.col("client_id") * 100000 + F.year("mois") * 12 + F.month("mois")).alias("usage_id"),
        "client_id",
        "mois",
        F.floor("qty").cast("bigint").alias("nb_connexions"),
        F.col("volume").cast("decimal(20,2)").alias("volume_data_go"),
        F.col("n_lines").cast("int").alias("duree_appels_min"),
        F.col("mois").cast("timestamp_ntz").alias("created_at"),
    )


BUILDERS = {
    "clients": clients,
    "produits": produits,
    "abonnements": abonnements,
    "facturation": facturation,
    "interactions_support": interactions_support,
    "usage_mensuel": usage_mensuel,
}


class SourceTables(Mapping):
    """The six source tables of one test directory, derived on first access.

    Driver tables are read once and shared by every source table built from
    them (``orders`` feeds three, ``lineitem`` three).  Reusing one relation
    in several branches of a plan is an ordinary self-join for the analyzer;
    the physical plan is the same as with separate reads.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self._spark, self._dir, name)
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self.raw)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def load_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """All six source tables, derived lazily from the driver test tables."""
    return SourceTables(spark, sf_dir)


# DuckDB text of the same mapping, one CTE per source table.  Used only by
# ``oracle_sql()``; DuckDB runs it over the pre-registered test views.
ORACLE_CTES = {
    "clients": """clients AS (
  SELECT c.c_custkey AS client_id,
         CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS date_inscription,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS genre,
         CAST(CASE WHEN c.c_custkey % 6 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS senior_citizen,
         CASE WHEN c.c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS partenaire,
         CASE WHEN c.c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS personnes_a_charge,
         c.c_mktsegment AS canal_acquisition,
         r.r_name AS region,
         CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "produits": """produits AS (
  SELECT p_partkey AS produit_id,
         p_name AS nom,
         CASE WHEN split_part(p_type, ' ', 1) IN ('ECONOMY', 'STANDARD') THEN 'Internet'
              WHEN split_part(p_type, ' ', 1) IN ('MEDIUM', 'SMALL') THEN 'Mobile'
              ELSE 'Bundle' END AS categorie,
         CAST(p_retailprice AS DECIMAL(10,2)) AS tarif_base
  FROM part
)""",
    "abonnements": """abonnements AS (
  SELECT o.o_orderkey AS abonnement_id,
         o.o_custkey AS client_id,
         fp.produit_id,
         CAST(o.o_orderdate AS DATE) AS date_debut,
         CASE WHEN o.o_orderstatus = 'F'
              THEN CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 720 AS INTEGER) AS DATE) END AS date_fin,
         CAST(o.o_totalprice AS DECIMAL(10,2)) AS tarif_mensuel,
         CASE WHEN substr(o.o_orderpriority, 1, 1) IN ('1', '2') THEN 'Mensuel'
              WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN '1_an'
              ELSE '2_ans' END AS type_contrat,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS facturation_sans_papier,
         CASE WHEN o.o_orderkey % 4 = 0 THEN 'CB' WHEN o.o_orderkey % 4 = 1 THEN 'Virement'
              WHEN o.o_orderkey % 4 = 2 THEN 'Prélèvement' ELSE 'Chèque' END AS mode_paiement,
         CASE WHEN o.o_orderstatus = 'F' THEN 'résilié' ELSE 'actif' END AS statut,
         CAST(o.o_orderdate AS TIMESTAMP) AS created_at
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS produit_id FROM lineitem GROUP BY l_orderkey) fp
    ON o.o_orderkey = fp.l_orderkey
)""",
    "facturation": """facturation AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS facture_id,
         o.o_custkey AS client_id,
         CAST(l.l_shipdate AS DATE) AS date_facture,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS montant,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE 1 END AS SMALLINT) AS paye_a_temps,
         CAST(CAST(l.l_shipdate AS DATE) + CASE WHEN l.l_returnflag = 'R' THEN 45 ELSE 7 END AS DATE) AS date_paiement,
         CAST(l.l_shipdate AS TIMESTAMP) AS created_at
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
)""",
    "interactions_support": """interactions_support AS (
  SELECT event_id AS interaction_id,
         user_id AS client_id,
         CAST(DATE '1999-12-01' + CAST((day(ts) - 1) * 15 AS INTEGER) AS DATE) AS date_interaction,
         CASE WHEN event_id % 3 = 0 THEN 'appel' WHEN event_id % 3 = 1 THEN 'ticket' ELSE 'chat' END
           AS type_interaction,
         CASE WHEN event_type = 'error' THEN 'résiliation' WHEN event_type = 'purchase' THEN 'facturation'
              ELSE 'technique' END AS theme,
         CAST(CASE WHEN value < 75 THEN 1 ELSE 0 END AS SMALLINT) AS resolution_satisfaisante,
         CAST(ts AS TIMESTAMP) AS created_at
  FROM events
)""",
    "usage_mensuel": """usage_mensuel AS (
  SELECT client_id * 100000 + year(mois) * 12 + month(mois) AS usage_id,
         client_id,
         mois,
         CAST(FLOOR(qty) AS BIGINT) AS nb_connexions,
         CAST(volume AS DECIMAL(20,2)) AS volume_data_go,
         CAST(n_lines AS INTEGER) AS duree_appels_min,
         CAST(mois AS TIMESTAMP) AS created_at
  FROM (
    SELECT o.o_custkey AS client_id,
           CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS mois,
           SUM(l.l_quantity) AS qty,
           SUM(CAST(l.l_extendedprice AS DECIMAL(10,2))) AS volume,
           COUNT(*) AS n_lines
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY 1, 2
  ) m
)""",
}


def oracle_with(*tables: str) -> str:
    """``WITH`` clause holding the DuckDB mapping of the named source tables."""
    return "WITH " + ",\n".join(ORACLE_CTES[t] for t in tables)
