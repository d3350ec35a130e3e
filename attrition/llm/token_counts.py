"""Token counts of documents in flat, unindexed token files.

A flat file is a run of token ids, 16 or 32 bits wide as the vocabulary needs, with an end-of-document id after each
document and no index, cut into blocks of fixed size that ignore document
bounds.  Every block is searched for the end id on its own (vectorised); the
ends before a block and the last end before it come from a prefix scan over
one small row per block, first inside runs of blocks, then over the runs, so
no file is read by one task.

``write_flat`` makes such files from documents (ids without an end id are cut
at the next end; tokens after the last end count as a document without an end).
Null texts are empty documents of one token, the end id.  An empty table has no
files and no counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import id_and_text, stored, text_chunks
from attrition.llm.pieces import worker_encoder

CHUNK_CHARS = 1 << 19
RUN = 1024      # blocks scanned together in the first step of the prefix scan
FLAT = "file int, block bigint, tokens binary, ids array<bigint>, first_doc bigint"


def id_bytes(tokenizer_path: str, end_id: int) -> int:
    """Bytes that hold every id of the file and the end id: 2 or 4."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()
    return 2 if max(end_id, *ids) < 1 << 16 else 4


def _flat_blocks(tokenizer_path: str, end_id: int, block_tokens: int, width: int):
    schema = pa.schema([("file", pa.int32()), ("block", pa.int64()), ("tokens", pa.binary()),
                        ("ids", pa.list_(pa.int64())), ("first_doc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file, block, doc = TaskContext.get().partitionId(), 0, 0
        encoder = worker_encoder(tokenizer_path)
        rest = np.zeros(0, f"<u{width}")
        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            flat, n = encoder.encode(texts)
            rest = np.append(rest, np.insert(flat, np.cumsum(n), end_id).astype(rest.dtype))
            full = len(rest) // block_tokens
            rows = [{"file": file, "block": block + k, "tokens": rest[k * block_tokens:(k + 1) * block_tokens].tobytes(),
                     "ids": None, "first_doc": None} for k in range(full)]
            rows.append({"file": file, "block": None, "tokens": None, "ids": ids, "first_doc": doc})
            block, doc, rest = block + full, doc + len(ids), rest[full * block_tokens:]
            yield pa.RecordBatch.from_pylist(rows, schema)
        if len(rest):
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "tokens": rest.tobytes(), "ids": None,
                                               "first_doc": None}], schema)
    return run


def write_flat(df: DataFrame, tokenizer_path: str, end_id: int = 50256, id_col: str = "doc_id",
               text_col: str = "text", block_tokens: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """(blocks: file, block, tokens; manifest: file, doc, id) of a flat token file per scan task.

    Ids are :func:`id_bytes` wide.
    """
    rows = stored(id_and_text(df, id_col, text_col).mapInArrow(
        _flat_blocks(tokenizer_path, end_id, block_tokens, id_bytes(tokenizer_path, end_id)), FLAT), "flat_tokens")
    blocks = rows.filter(F.col("block").isNotNull()).select("file", "block", "tokens")
    manifest = rows.filter(F.col("block").isNull()).select("file", "first_doc", F.posexplode("ids").alias("k", id_col)).select(
        "file", (F.col("first_doc") + F.col("k")).alias("doc"), id_col)
    return blocks, manifest


def _find_ends(end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                tokens = np.frombuffer(blob, f"<u{width}")
                ends = np.flatnonzero(tokens == end_id)
                yield pa.RecordBatch.from_pylist(
                    [{"file": file, "block": block, "size": len(tokens), "ends": ends.tolist()}],
                    pa.schema([("file", pa.int32()), ("block", pa.int64()), ("size", pa.int64()),
                               ("ends", pa.list_(pa.int64()))]))
    return run


def count_tokens(blocks: DataFrame, end_id: int = 50256, width: int = 2) -> DataFrame:
    """One row per document of the files: file, doc (from 0), start, n_tokens (end id included), ended.

    ``width``: bytes of an id in the blocks (2 or 4).
    """
    if width not in (2, 4) or end_id >= 1 << 8 * width:
        raise ValueError(f"end id {end_id} does not fit ids of {width} bytes")
    found = stored(blocks.mapInArrow(_find_ends(end_id, width), "file int, block bigint, size bigint, ends array<bigint>"),
                   "ends").withColumn("run", F.floor(F.col("block") / RUN))
    small = found.select("file", "run", "block", "size", F.size("ends").cast("long").alias("n"),
                         F.try_element_at("ends", F.lit(-1)).alias("last"))

    def scan(rows: DataFrame, group: list[str], order: str) -> DataFrame:
        """Tokens, ends and the last end (from the group's start) before each row."""
        w = W.partitionBy(*group).orderBy(order)
        rows = rows.withColumn("base", F.sum("size").over(w) - F.col("size"))
        before = w.rowsBetween(W.unboundedPreceding, -1)
        return rows.select(*group, order, "size", "n", "last", "base", (F.sum("n").over(w) - F.col("n")).alias("n_before"),
                           F.max(F.col("base") + F.col("last")).over(before).alias("last_before"))

    inner = scan(small, ["file", "run"], "block")
    runs = inner.groupBy("file", "run").agg(
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.max(F.col("base") + F.col("last")).alias("last"))
    outer = scan(runs, ["file"], "run").select(
        "file", "run", F.col("base").alias("run_base"), F.col("n_before").alias("run_n"),
        F.col("last_before").alias("run_last"))
    placed = inner.join(outer, ["file", "run"]).select(
        "file", "block", (F.col("run_base") + F.col("base")).alias("base"),
        (F.col("run_n") + F.col("n_before")).alias("first_doc"),
        F.coalesce(F.col("run_base") + F.col("last_before"), "run_last", F.lit(-1)).alias("previous"))
    closed = found.join(placed, ["file", "block"]).select(
        "file", "first_doc", "previous", "base", F.posexplode("ends").alias("k", "end"), "ends")
    documents = closed.select(
        "file", (F.col("first_doc") + F.col("k")).alias("doc"),
        (F.when(F.col("k") > 0, F.col("base") + F.get("ends", F.col("k") - 1)).otherwise(F.col("previous")) + 1).alias("start"),
        (F.col("base") + F.col("end") + 1).alias("stop"), F.lit(True).alias("ended"))
    tails = runs.groupBy("file").agg(F.sum("n").alias("doc"), F.sum("size").alias("stop")).join(
        outer.join(runs.select("file", "run", "last"), ["file", "run"]).groupBy("file").agg(
            F.coalesce(F.max(F.col("run_base") + F.col("last")) + 1, F.lit(0).cast("long")).alias("start")), "file").filter(
        "start < stop").select("file", "doc", "start", "stop", F.lit(False).alias("ended"))
    return documents.unionByName(tails).select("file", "doc", "start", (F.col("stop") - F.col("start")).alias("n_tokens"),
                                               "ended")
