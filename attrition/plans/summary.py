"""Run summaries: rows, churn rate, split sizes -- one aggregate each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_summary(features: DataFrame, target: str = "churn") -> DataFrame:
    """Row count, churned rows and churn rate, in a single job."""
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(target)), F.lit(0)).cast("long").alias("n_churn"),
        F.avg(F.col(target).cast("double")).alias("churn_rate"),
    )


def split_summary(split: DataFrame, label: str = "label") -> DataFrame:
    """Rows per (split, class)."""
    return split.groupBy("split", F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
