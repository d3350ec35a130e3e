"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``; every decision takes effect on the rows.

1. language_id: documents that fit no language (no letters, or letters no language explains) go.
2. exact_dedup: of equal texts the one with the largest id stays.
3. near_dedup: of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles, one stays.
4. suffix_dedup: strings of 200 bytes (shorter than any passage of 50 words) that occur twice are
   cut out; a document with no text left goes.
5. packing: what is left, in windows of 1024 tokens.

Null texts count as empty and leave at stage 1; null ids are documents of
their own; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import exact, jaccard, langid, packing, suffix
from attrition.llm.common import stored

TOKENIZER = "byte_bpe_50k.json"
REPEAT_BYTES = 200
WINDOW = 1024


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    found = langid.identify(docs, langid.train(docs), "doc_id", text=text, declared=F.col("lang"), suffix=F.lit(None),
                            host=F.col("source"), domain=F.lit(None), key=suffix.text_key(text))
    # written, so that its size decides how it meets the documents
    rejected = stored(found.filter(F.col("lang") == langid.UND).select(
        F.col("doc_id").alias("__x_id"), F.col("row_key").alias("__x_key")).distinct(), "rejected")
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col("__x_id")) & (suffix.text_key(text) == F.col("__x_key")),
                     "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, jaccard.join(docs, width=5, num=4, den=5))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffix.remove_repeats(docs, REPEAT_BYTES)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).filter("n_chars > 0")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), window=WINDOW)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack_tokens),
]
ORACLE_SQL = None  # no stage but exact_dedup can be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
