"""Checks while writing: one pass over a feed gives the valid rows, the rejected ones with their reasons, and the counts.

The feed is read once: rows take the reasons that they show on their own (NOT NULL, value domains, lengths) and are
materialised.  Keys that occur twice and references without a parent are then found on the key columns of
that copy, both reduced to one row per key before any join, so a hot key is one row; AQE broadcasts them where they are few
and splits a hot key's rows where they are not.  One write puts rows into ``status=valid`` and
``status=rejected``, and an ``Observation`` counts every rule on the way.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators.quality import domain_rules
from attrition.session import cut_lineage
from attrition.sources.schema import TableContract

REASONS, STATUS = "reasons", "status"
VALID, REJECTED = "valid", "rejected"


@dataclass(frozen=True)
class Ingested:
    valid: DataFrame                # the feed's columns
    rejected: DataFrame             # the feed's columns and ``reasons``
    counts: dict[str, int]          # rows by reason, and ``rows``, ``valid``, ``rejected``


def row_rules(contract: TableContract, columns: list[str]) -> dict[str, Column]:
    """Reason -> predicate, for what a row shows on its own."""
    rules = {f"{c}: null": F.col(c).isNull() for c in contract.not_null if c in columns}
    for column, rule, violated in domain_rules(contract):
        if column in columns:
            rules[f"{column}: {rule}"] = violated
    return rules


def marked(feed: DataFrame, contract: TableContract, parents: Mapping[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """(``feed`` with the reasons of each row, all reasons there are)."""
    rules = row_rules(contract, feed.columns)
    own = F.filter(F.array(*[F.when(violated, F.lit(reason)) for reason, violated in rules.items()]), lambda r: r.isNotNull())
    rows = cut_lineage(feed.withColumn(REASONS, own))
    key = contract.primary_key
    repeated = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__key", F.lit(f"{key}: duplicate").alias("__r0"))
    out, extra = rows.join(repeated, F.col(key) == F.col("__key"), "left").drop("__key"), ["__r0"]
    reasons = [*rules, f"{key}: duplicate"]
    for column, (parent, parent_key) in contract.foreign_keys.items():
        if column in feed.columns and parent in parents:
            reason, mark = f"{column}: orphan", f"__r{len(extra)}"
            refs = rows.filter(F.col(column).isNotNull()).select(F.col(column).alias("__ref")).distinct()
            lost = refs.join(parents[parent].select(F.col(parent_key).alias("__ref")).distinct(), "__ref", "left_anti").select(
                "__ref", F.lit(reason).alias(mark))
            out = out.join(lost, F.col(column) == F.col("__ref"), "left").drop("__ref")
            extra.append(mark)
            reasons.append(reason)
    found = F.concat(REASONS, F.filter(F.array(*extra), lambda r: r.isNotNull()))
    return out.withColumn(REASONS, found).drop(*extra), reasons


def write_checked(feed: DataFrame, contract: TableContract, path: str, parents: Mapping[str, DataFrame]) -> Ingested:
    """Write ``feed`` under ``path``, valid and rejected rows apart (every row once)."""
    rows, reasons = marked(feed, contract, parents)
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) == 0).alias(VALID),
                           F.count_if(F.size(REASONS) > 0).alias(REJECTED),
                           *[F.count_if(F.array_contains(REASONS, r)).alias(r) for r in reasons])
    status = F.when(F.size(REASONS) == 0, VALID).otherwise(REJECTED)
    watched.withColumn(STATUS, status).write.partitionBy(STATUS).parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField(STATUS, T.StringType())])
    stored = feed.sparkSession.read.schema(schema).parquet(path)
    return Ingested(stored.filter(F.col(STATUS) == VALID).drop(REASONS, STATUS),
                    stored.filter(F.col(STATUS) == REJECTED).drop(STATUS), dict(seen.get))
