"""SimHash fingerprints and search within a Hamming radius.

Every distinct word votes on 64 signed bits with its hash, weighted by
1 + ln(its count); the signs are the fingerprint.  A text without words has
fingerprint 0; null texts are empty; equal texts have equal fingerprints.

``near_pairs`` cuts the fingerprints into blocks: two that differ in at most
``radius`` bits agree on all but ``radius`` of the blocks, so a table for
every choice of the other blocks (a permutation that puts them in front) finds
each pair by equality.  Equal fingerprints are one class first, so copies
make no pairs among themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import id_and_text, shuffle_partitions, stored, text_chunks
from attrition.llm.words import doc_numbers, word_hashes

BITS = 64
CHUNK_CHARS = 1 << 19


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    out = np.zeros(len(texts), np.uint64)
    hashes, per_text = word_hashes(texts)
    if not len(hashes):
        return out
    doc = doc_numbers(per_text)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    terms, doc = hashes[at], doc[at]
    weights = (1 + np.log(counts)).astype(np.float32)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    votes = np.zeros((len(texts), BITS), np.float32)
    for k in np.flatnonzero(np.diff(bounds)):
        a, b = bounds[k], bounds[k + 1]
        for lo in range(a, b, 1 << 16):     # a long text in parts
            part = slice(lo, min(b, lo + (1 << 16)))
            signs = np.unpackbits(terms[part].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
            votes[k] += 2 * (weights[part] @ signs.astype(np.float32)) - weights[part].sum()
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b) / BITS


def hexadecimal(x: np.ndarray) -> list[str]:
    return [f"{v:016x}" for v in x.tolist()]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fingerprint`` (64 bits in a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(fingerprint_texts(texts).view(np.int64))],
                names=["_id", "fingerprint"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "_id bigint, fingerprint bigint").withColumnRenamed(
        "_id", id_col)


def near_pairs(prints: DataFrame, radius: int = 3, blocks: int | None = None, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(classes, pairs) of fingerprints at most ``radius`` bits apart.

    classes: ``id_col`` and ``class_id``, the smallest id with the same
    fingerprint; pairs: class_a < class_b and their ``distance``, each once.
    """
    blocks = blocks or radius + 3
    classes = stored(prints.join(prints.groupBy("fingerprint").agg(F.min(id_col).alias("class_id")), "fingerprint"),
                     "classes")
    distinct = classes.select("fingerprint", "class_id").distinct()
    cuts = [BITS * k // blocks for k in range(blocks + 1)]

    def key(chosen: tuple[int, ...]):
        mask = 0
        for k in chosen:
            mask |= ((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k]
        return F.col("fingerprint").bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))

    tables = list(combinations(range(blocks), blocks - radius))
    keyed = distinct.select("fingerprint", "class_id", F.posexplode(F.array(*[key(t) for t in tables])).alias("t", "key"))
    left = keyed.select("t", "key", F.col("fingerprint").alias("a"), F.col("class_id").alias("class_a"))
    right = keyed.select("t", "key", F.col("fingerprint").alias("b"), F.col("class_id").alias("class_b"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (left.join(right, ["t", "key"]).filter((F.col("class_a") < F.col("class_b")) & (distance <= radius))
             .select("class_a", "class_b", distance.alias("distance")).distinct())
    return classes.select(id_col, "class_id"), pairs


def map_with_next(df: DataFrame, func: Callable[[list, list[str], list[str]], list], fields: list[tuple[str, pa.DataType, str]],
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``func(ids, texts, next texts)`` over all rows, where the next row is the one
    that follows in descending id order (the first one after the last).

    Rows are range-partitioned; only the last row of each partition waits for
    the first text of the next, through a join of one row per partition.
    ``fields``: name, Arrow type and SQL type of what ``func`` returns, as columns.
    """
    names = [n for n, _, _ in fields]
    edge_schema = pa.schema([*((n, t) for n, t, _ in fields), ("_part", pa.int32()), ("_edge", pa.string()),
                             ("_id", pa.int64()), ("_text", pa.string())])

    def results(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
        return [pa.array(v, t) for v, (_, t, _) in zip(func(ids, texts, following), fields, strict=True)]

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def edge(kind: str, i, text: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"_part": part, "_edge": kind, "_id": i, "_text": text}], edge_schema)

        held: tuple | None = None
        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            if held is None:
                yield edge("first", ids[0], texts[0])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                done = results(ids[:-1], texts[:-1], texts[1:])
                blank = [pa.nulls(len(ids) - 1, edge_schema.field(k).type) for k in ("_part", "_edge", "_id", "_text")]
                yield pa.RecordBatch.from_arrays([*done, *blank], schema=edge_schema)
        if held is not None:
            yield edge("last", *held)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(results(*(batch.column(k).to_pylist() for k in range(3))), names=names)

    sql = ", ".join(f"{n} {s}" for n, _, s in fields)
    order = [F.col("_id").desc_nulls_last(), F.col("_tie").desc()]
    ordered = (id_and_text(df, id_col, text_col).withColumn("_tie", F.xxhash64("_text"))
               .repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
               .select("_id", "_text"))
    rows = stored(ordered.mapInArrow(inner, f"{sql}, _part int, _edge string, _id bigint, _text string"), "with_next")
    first = rows.filter("_edge = 'first'").select(F.col("_part").alias("_next"), F.col("_text").alias("_following"))
    parts = rows.filter("_edge = 'first'").select("_part")
    follow = parts.select("_part", F.coalesce(F.lead("_part").over(W.orderBy("_part")),
                                              F.min("_part").over(W.partitionBy())).alias("_next"))
    edges = rows.filter("_edge = 'last'").select("_part", "_id", "_text").join(follow, "_part").join(first, "_next")
    return rows.filter("_edge IS NULL").select(*names).unionByName(
        edges.select("_id", "_text", "_following").mapInArrow(outer, sql))
