"""The reference's inline product catalogue (four offers), as a DataFrame."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from attrition.sources.schema import contracts

# --- fixed values: product catalogue of the reference ---------------------
CATALOGUE = (
    ("DSL", "Internet DSL", "Internet", Decimal("35.00")),
    ("FIBRE", "Fibre", "Internet", Decimal("65.00")),
    ("MOBILE", "Mobile seul", "Mobile", Decimal("25.00")),
    ("BUNDLE", "Internet + Mobile", "Bundle", Decimal("75.00")),
)


def catalogue(spark: SparkSession) -> DataFrame:
    """Four rows, typed by the ``produits`` contract (string ids)."""
    return spark.createDataFrame(list(CATALOGUE), contracts()["produits"].schema)
