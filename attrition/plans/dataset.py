"""Dataset export: feature table -> CSV, plus its run summary.

The export uses the script rules by default (that is how the dataset file is
produced upstream) and keeps the 25-column export order.  The CSV is written
by the executors as a folder of part files; the summary is one aggregate.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from attrition.plans.features import (REFERENCE_REF, REFERENCE_START, SCRIPT_OPTIONS, FeatureOptions,
                                      build_features, export_profile)
from attrition.plans.summary import dataset_summary
from attrition.sources import files
from attrition.sources.schema import export_schema


def export_dataset(tables: Mapping[str, DataFrame], path: str, ref: dt.date = REFERENCE_REF,
                   start: dt.date = REFERENCE_START, options: FeatureOptions = SCRIPT_OPTIONS,
                   label_ids: DataFrame | None = None) -> DataFrame:
    """Write the export profile as CSV under ``path``; return the one-row summary
    (rows, churned rows, churn rate) computed from the written file."""
    feats = export_profile(build_features(tables, ref, start, options=options, label_ids=label_ids))
    files.write_csv(feats, path)
    spark = feats.sparkSession
    return dataset_summary(read_dataset(spark, path, feats.schema["client_id"].dataType))


def read_dataset(spark: SparkSession, path: str, key_type: T.DataType = T.StringType()) -> DataFrame:
    """Read an exported dataset CSV with the export types (no inference)."""
    return files.read_csv(spark, path, export_schema(key_type))
