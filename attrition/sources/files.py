"""File sources and sinks: CSV export / import with an explicit schema,
Parquet for anything internal, and the shared output folder.

The CSV sink writes a directory of part files (one per task, no BOM);
reading back always uses the declared schema, never inference.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from attrition.session import ensure_checkpoint_dir
from attrition.sources import csv_ranges


# a field in quotes holds a quote as two; nothing is null and "" is the empty text; spaces stay
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
WRITE_EMPTY = {"nullValue": "", "emptyValue": '""'}
READ_EMPTY = {"nullValue": "\u0001null\u0001", "emptyValue": ""}    # a null is marked by what no field holds


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local
    on a cluster: the checkpoint folder is the one the cluster names)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts, uuid.uuid4().hex])


def write_csv(df: DataFrame, path: str) -> str:
    """Header + UTF-8 CSV, overwrite; the writer creates the folder.

    Quotes are doubled, as other CSV tools write them; an empty text is ``""``, a null is nothing.
    """
    df.write.mode("overwrite").options(header=True, encoding="UTF-8", **CSV_TEXT, **WRITE_EMPTY).csv(path)
    return path


def read_csv_by_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and the declared schema, one task per file; a leading BOM on the first
    header name is dropped by the reader.  Quoted fields may hold quotes, commas and newlines; empty
    fields are null, ``""`` is the empty text; a malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .options(multiLine=True, mode="FAILFAST", **CSV_TEXT, **READ_EMPTY)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of :func:`read_csv_by_file`, with every file dealt to tasks by byte ranges
    (see :mod:`attrition.sources.csv_ranges`; the ranges' quotes are counted when this is called)."""
    found = csv_ranges.records(spark, path)
    if found is None:   # no newline inside a field: Spark splits such files itself
        return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
                .options(mode="FAILFAST", **CSV_TEXT, **READ_EMPTY).csv(path))
    return csv_ranges.parsed(found, schema, {"mode": "FAILFAST", "multiLine": "true", **CSV_TEXT, **READ_EMPTY})


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
