"""Parquet layout for the six source tables.

Facts are written partitioned by their own date column (``date_facture``,
``date_interaction``, ``mois``, ``date_debut``), so the period filter of the
feature query prunes whole directories (``PartitionFilters``) instead of
relying on row-group statistics.  Partitioning on the column the query
filters on needs no extra predicate: pruning is exact.

Inside each date directory, rows are clustered by ``client_id`` (then the
primary key).  This stands in for the relational indexes on ``client_id``
(and ``(client_id, mois)`` for usage): Parquet keeps min/max statistics per
row group, so a filter on a client reads only the row groups whose range
holds it.  The date directory plus the client statistics give the
``(client_id, mois)`` lookup.  The two dimensions are written ordered by
their primary key.  No index is kept for the two-valued status column,
where it would prune nothing.

Not bucketed on ``client_id`` on purpose: every ``client_id`` shuffle in the
feature plan carries partially aggregated rows (one per client per task),
so bucketing would save little, while a client holding a third of the rows
would make one bucket -- and one scan task -- hold a third of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.files import shared_dir
from attrition.sources.schema import TABLES, TableContract, contracts

PRIMARY_KEYS = {name: c.primary_key for name, c in contracts().items()}

CLUSTER_BY = "client_id"

# --- fixed values: partition column of each table (None = not partitioned)
PARTITION_BY = {
    "clients": None,
    "produits": None,
    "abonnements": "date_debut",
    "facturation": "date_facture",
    "interactions_support": "date_interaction",
    "usage_mensuel": "mois",
}


def save_tables(tables: Mapping[str, DataFrame], location: str) -> str:
    """Write each table as Parquet under ``location/<table>``, facts partitioned by date.

    Rows are range-partitioned on (date, client, primary key) and sorted the
    same way inside each task.  Each task then writes few date directories,
    its files are ordered by client (tight row-group statistics), and a date
    or a client holding a third of all rows is still cut across many tasks,
    because the unique key splits it.  The sort is local to each task: no
    extra shuffle.  The writer's own sort on the partition column is already
    satisfied.
    """
    for name in TABLES:
        df = tables[name]
        part = PARTITION_BY[name]
        path = f"{location.rstrip('/')}/{name}"
        # dimensions: ordered by their key (the primary-key index)
        keys = [part, CLUSTER_BY, PRIMARY_KEYS[name]] if part else [PRIMARY_KEYS[name]]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        writer = df.write.mode("overwrite")
        if part:
            writer = writer.partitionBy(part)
        writer.parquet(path)
    return location


def load_tables(spark: SparkSession, location: str, schemas: Mapping[str, object] | None = None
                ) -> dict[str, DataFrame]:
    """Read the six tables back, with the table contract's column order."""
    out = {}
    for name in TABLES:
        df = spark.read.parquet(f"{location.rstrip('/')}/{name}")
        if schemas and name in schemas:
            df = df.select(*[f.name for f in schemas[name].fields])
        out[name] = df
    return out


SQL_DEFAULTS = {type(None): lambda v: "localtimestamp()", str: lambda v: "'" + v.replace("'", "\\'") + "'"}


def create_table_sql(name: str, contract: TableContract, location: str, partitioned: bool = True) -> str:
    """The table as Spark SQL: types, NOT NULL and DEFAULT clauses, facts partitioned by their date."""
    columns = []
    for f in contract.schema.fields:
        clause = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in contract.not_null:
            clause += " NOT NULL"
        if f.name in contract.defaults:
            value = contract.defaults[f.name]
            clause += " DEFAULT " + SQL_DEFAULTS.get(type(value), str)(value)
        columns.append(clause)
    part = PARTITION_BY[contract.name] if partitioned else None
    return (f"CREATE TABLE {name} (" + ", ".join(columns) + ") USING parquet"
            + (f" PARTITIONED BY (`{part}`)" if part else "") + f" LOCATION '{location}'")


class CatalogueTables:
    """Tables of a schema of the session's catalogue, filled by INSERTs that may leave columns out.

    Use as a context: the schema and its tables leave the catalogue at the end, the files stay under ``location``.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, TableContract], location: str, partitioned: bool = True):
        self.spark, self.tables, self.location, self.partitioned = spark, tables, location.rstrip("/"), partitioned
        self.schema = f"attrition_{uuid.uuid4().hex}"

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def __enter__(self) -> CatalogueTables:
        self.spark.sql(f"CREATE SCHEMA {self.schema} LOCATION '{self.location}/schema'")
        for table, contract in self.tables.items():
            self.spark.sql(create_table_sql(self.name(table), contract, f"{self.location}/{table}", self.partitioned))
        return self

    def __exit__(self, *error) -> None:
        self.spark.sql(f"DROP SCHEMA {self.schema} CASCADE")

    def insert(self, table: str, rows: DataFrame) -> None:
        """Append ``rows``; columns that they lack take their DEFAULT (or null).  A null in a NOT NULL column fails
        the insert, and nothing is written then."""
        contract = self.tables[table]
        needed = [c for c in contract.not_null if c in rows.columns]
        checked = rows.withColumns({c: F.coalesce(c, F.raise_error(F.lit(f"null in {table}.{c}")).cast(rows.schema[c].dataType))
                                    for c in needed})
        missing = [c for c in contract.not_null if c not in rows.columns and c not in contract.defaults]
        if missing:
            raise ValueError(f"{table} needs {', '.join(missing)}")
        columns = ", ".join(f"`{c}`" for c in rows.columns)
        self.spark.sql(f"INSERT INTO {self.name(table)} ({columns}) SELECT {columns} FROM {{rows}}", rows=checked)

    def stored(self, table: str) -> DataFrame:
        """The rows of the files themselves, also after the catalogue has forgotten the table."""
        contract = self.tables[table]
        return self.spark.read.schema(contract.schema).parquet(f"{self.location}/{table}").select(*contract.columns)


def catalogue_tables(spark: SparkSession, tables: Mapping[str, TableContract] | None = None, location: str | None = None,
                     partitioned: bool = True) -> CatalogueTables:
    """The six tables (or ``tables``) in a schema of their own, under the shared folder unless ``location`` is given."""
    return CatalogueTables(spark, tables or contracts(), location or shared_dir(spark, "catalogue"), partitioned)


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Expose the six tables as session temporary views under their own names.

    SQL written against the relational tables (``FROM abonnements a JOIN
    produits p ...``) then runs unchanged through ``spark.sql``.  Views are
    plans, not copies: nothing is read or materialized here.
    """
    for name in TABLES:
        tables[name].createOrReplaceTempView(name)
    return list(TABLES)
