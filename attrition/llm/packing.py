"""Packing token sequences into windows by minimum bin slack.

Documents are cut into full windows and one shorter rest.  The rests are a
multiset of lengths below the window; a bitset subset-sum over those lengths picks,
around the longest one left, the lengths that fill a window closest to its
capacity, and the same choice is used for as many windows as the counts allow.
The plan depends on the histogram of lengths only (at most one entry per
length), so it is made on the driver whatever the input size; pieces then find
their window from their rank among the pieces of their length.

Null texts are empty; with the end id a document has one id at least, without
one an empty document has no piece.  Repeated ids are separate documents; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import crc32_u32, id_and_text, shuffle_partitions, stored_by_key, text_chunks, trimmed
from attrition.llm.pieces import worker_encoder

CHUNK_CHARS = 1 << 19
PIECES = "_id bigint, start bigint, length int, doc_tokens bigint, ids_crc32 bigint, ids binary, block int, nth bigint"


def _cut(tokenizer_path: str, end_id: int | None, window: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        encoder = worker_encoder(tokenizer_path)
        seen = np.zeros(window + 1, np.int64)   # pieces of each length so far in this block
        for doc_ids, texts in text_chunks(batches, CHUNK_CHARS):
            flat, counts = encoder.encode(texts)
            out: dict[str, list] = {k: [] for k in ("_id", "start", "length", "doc_tokens", "ids_crc32", "ids")}
            at = 0
            for doc, n in zip(doc_ids, counts.tolist(), strict=True):
                ids = flat[at:at + n]
                at += n
                if end_id is not None:
                    ids = np.append(ids, end_id)
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window].astype("<u4")
                    for k, v in (("_id", doc), ("start", start), ("length", len(piece)), ("doc_tokens", len(ids)),
                                 ("ids_crc32", crc32_u32(piece)), ("ids", piece.tobytes() if keep_ids else None)):
                        out[k].append(v)
            length = np.array(out["length"], np.int64)
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - first
            nth += seen[length]
            seen += np.bincount(length, minlength=window + 1)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
                + [pa.array(np.full(len(length), block), pa.int32()), pa.array(nth, pa.int64())],
                names=[*out, "block", "nth"])
    return run


def fill_window(counts: dict[int, int], room: int) -> list[int]:
    """Lengths (with repetition, within ``counts``) whose sum is as near to ``room`` as can be, not above it.

    Bitset subset-sum: bit s of ``reach`` says that s can be reached; each
    length enters in portions of 1, 2, 4 ... copies and every step's bitset is
    kept to read the choice back.
    """
    reach, limit = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((k for k, c in counts.items() if c and k <= room), reverse=True):
        left, portion = min(counts[length], room // length), 1
        while left:
            take = min(portion, left)
            steps.append((length, take, reach))
            reach = (reach | reach << (length * take)) & limit
            left, portion = left - take, portion * 2
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            best -= length * take
            chosen += [length] * take
    return chosen


def plan_windows(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a window, number of such windows) until every piece has its place."""
    counts, plan = dict(histogram), []
    while any(counts.values()):
        longest = max(k for k, c in counts.items() if c)
        counts[longest] -= 1
        chosen = fill_window(counts, window - longest)
        counts[longest] += 1
        lengths = tuple(sorted([longest, *chosen], reverse=True))
        need = {k: lengths.count(k) for k in set(lengths)}
        times = min(counts[k] // n for k, n in need.items())
        for k, n in need.items():
            counts[k] -= n * times
        plan.append((lengths, times))
    return plan


def _places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """By length, for runs of ranks: (first rank, copies in a window, first window, offset of the first copy)."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first_window = 0
    for lengths, times in plan:
        offset = 0
        for k in sorted(set(lengths), reverse=True):
            copies = lengths.count(k)
            out[k].append((used[k], copies, first_window, offset))
            used[k] += copies * times
            offset += copies * k
        first_window += times
    return out


def _place(plan: list[tuple[tuple[int, ...], int]], at_length: int, at_rank: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: np.array(v, np.int64) for k, v in _places(plan).items()}
        for batch in batches:
            length = batch.column(at_length).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(at_rank).to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for k in np.unique(length).tolist():
                hit = np.flatnonzero(length == k)
                first, copies, window, start = tables[k][np.searchsorted(tables[k][:, 0], rank[hit], "right") - 1].T
                within = rank[hit] - first
                sequence[hit], offset[hit] = window + within // copies, start + within % copies * k
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])
    return run


def pack(df: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int | None = 0, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``id_col``, start, length, doc_tokens, ids_crc32, ids
    (little-endian unsigned 32-bit; null unless ``keep_ids``), sequence_id,
    offset.  Sequence ids run without a gap from 0.
    """
    # its table lies by block, so only the counts move when they meet the pieces
    pieces = stored_by_key(id_and_text(df, id_col, text_col).mapInArrow(
        trimmed(_cut(tokenizer_path, end_id, window, keep_ids)), PIECES), "pieces", "block", shuffle_partitions(df.sparkSession))
    # pieces of a length in each block, and how many lie in blocks before it
    per_block = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = per_block.select("length", "block", (F.sum("n").over(
        W.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    # one row per block, with at most ``window`` lengths
    of_block = before.groupBy(F.col("block").alias("_block")).agg(F.map_from_entries(
        F.collect_list(F.struct("length", "before"))).alias("before"))
    # one row per length: at most ``window`` rows
    histogram = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_windows(histogram, window)
    ranked = pieces.join(of_block.hint("shuffle_hash"), F.col("block") == F.col("_block")).select(
        "_id", "start", "length", "doc_tokens", "ids_crc32", "ids", (F.col("nth") + F.col("before")[F.col("length")]).alias("rank"))
    placed = ranked.mapInArrow(
        trimmed(_place(plan, 2, 6, ranked.columns)),
        "_id bigint, start bigint, length int, doc_tokens bigint, ids_crc32 bigint, ids binary, rank bigint, "
        "sequence_id bigint, offset bigint")
    return placed.select(F.col("_id").alias(id_col), "start", F.col("length").cast("long").alias("length"),
                         "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
