"""Data-quality jobs standing in for the engine-side constraints of the DDL
(primary key, foreign key, NOT NULL, value domains, VARCHAR length,
defaults) plus a dense surrogate key.

Every check is a distributed aggregate whose result has one row per rule,
so nothing but a handful of counts ever reaches the driver.  Checks that
group by a key pre-aggregate first (partial count per map task), so a key
holding a third of the rows collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions import one_spelling
from attrition.operators.ranking import ordered_position
from attrition.sources.schema import DOMAINS, TableContract


def _unpivot(row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """Turn the one-row result of a multi-rule ``agg`` into one row per rule."""
    return row.unpivot([c for c in row.columns if c not in names], names, label, value)


# ------------------------------------------------------------------ A8 unique
def dq_unique(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows, null keys, keys seen more than once and the rows they cover."""
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    dup = F.col("k").isNotNull() & (F.col("n") > 1)
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("n_null_keys"),
        F.count_if(dup).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).alias("n_duplicate_rows"),
    )


# ----------------------------------------------------------------- A9 orphans
def dq_orphans(child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str,
               parent_key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent (null references are exempt).

    The child is reduced to one row per distinct reference before the
    anti-join, so a hot reference is a single row in the shuffle.
    """
    refs = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("ref"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    keys = parent.select(F.col(parent_key).alias("ref"))
    orphans = refs.join(keys, "ref", "left_anti")
    return orphans.agg(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(parent_table).alias("parent_table"),
        F.count(F.lit(1)).alias("n_orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphan_rows"),
    )


# ------------------------------------------------------------------ A10 nulls
def dq_nulls(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Null count of each NOT NULL column, one scan for all columns."""
    cols = list(columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    out = _unpivot(row, cols, "column_name", "n_nulls")
    return out.select(F.lit(table).alias("table_name"), "column_name", "n_nulls")


# ----------------------------------------------------------------- A11 domain
def domain_rules(contract: TableContract, domains: Mapping[tuple[str, str], tuple] = DOMAINS
                 ) -> list[tuple[str, str, Column]]:
    """(column, rule, violation predicate) for the domain and length rules of a table.

    Null values violate neither rule (NOT NULL is its own check).
    """
    rules: list[tuple[str, str, Column]] = []
    for (table, column), allowed in domains.items():
        if table == contract.name:
            rules.append((column, "domain", ~F.col(column).isin(list(allowed))))
    for column, n in contract.max_length.items():
        rules.append((column, f"length<={n}", F.length(F.col(column).cast("string")) > n))
    return rules


def dq_domain(df: DataFrame, contract: TableContract,
              domains: Mapping[tuple[str, str], tuple] = DOMAINS) -> DataFrame:
    """Violations per rule for one table, every rule in a single scan."""
    rules = domain_rules(contract, domains)
    names = [f"{column}/{rule}" for column, rule, _ in rules]
    row = df.agg(*[F.count_if(pred).alias(n) for n, (_, _, pred) in zip(names, rules)])
    counts = _unpivot(row, names, "rule_key", "n_violations")
    return counts.select(
        F.lit(contract.name).alias("table_name"),
        F.split_part("rule_key", F.lit("/"), F.lit(1)).alias("column_name"),
        F.split_part("rule_key", F.lit("/"), F.lit(2)).alias("rule"),
        "n_violations",
    )


# ---------------------------------------------------------------- A6 defaults
def conform(df: DataFrame, contract: TableContract, null_as_default: bool = False) -> DataFrame:
    """Cast to the table contract, in contract order, applying column defaults.

    A column missing from ``df`` takes its default (``DEFAULT`` semantics of
    an INSERT that omits the column); ``null_as_default`` also replaces
    explicit nulls.  ``created_at`` defaults to the current timestamp.  Values of a
    column's domain take one spelling, however a feed stores their accents.
    """
    present = set(df.columns)
    cols = []
    for field in contract.schema.fields:
        name, dtype = field.name, field.dataType
        if name in contract.defaults:
            d = contract.defaults[name]
            default = F.localtimestamp() if d is None else F.lit(d)
            if name not in present:
                value = default
            elif null_as_default:
                value = F.coalesce(F.col(name), default)
            else:
                value = F.col(name)
        else:
            value = F.col(name) if name in present else F.lit(None)
        allowed = DOMAINS.get((contract.name, name), ())
        if allowed and all(isinstance(v, str) for v in allowed):
            value = one_spelling(value, allowed)
        cols.append(value.cast(dtype).alias(name))
    return df.select(*cols)


# ----------------------------------------------------------- A7 surrogate key
def surrogate_key(df: DataFrame, order: list[str], name: str = "surrogate_id") -> DataFrame:
    """Dense 1..n key following ``order``, without a global window: the rank
    is computed range partition by range partition (see
    ``attrition.operators.ranking``).  Rows equal on every ``order`` column are
    interchangeable, so the output is deterministic up to such ties."""
    return ordered_position(df, order, name=name).withColumn(name, F.col(name) + 1)
