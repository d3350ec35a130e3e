"""Best-fit decreasing packing with a segment tree over remaining capacities.

Pieces are placed longest first, each into the open bin with the least room that still holds it, or into a
new bin.  The bins that matter to this rule differ only in their room, so they are kept by
room, and a segment tree over the rooms finds the tightest one in logarithmic time.  Pieces of one
length and bins of one history are interchangeable: a bin that takes a piece stays the
tightest one for the next piece of that length until it is full for it, so a whole class of bins
is filled in one step, with the same result as one piece at a time.

The plan needs the number of pieces of each length only (at most one entry per length, whatever the
input size; at most about 60 different lengths fit into a bin, which bounds its steps), so it is made on the driver.
Pieces then find their bin from their rank among the pieces of their length.

Documents are cut only where longer than a bin.  Null texts are empty; with the end id a
document has one id at least, without one an empty document has no piece.  Repeated or null ids are separate documents;
equal lengths are ranked in scan order; columns of the input besides id and text do not matter; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import crc32_u32, id_and_text, stored, text_chunks, trimmed
from attrition.llm.pieces import worker_encoder

CHUNK_CHARS = 1 << 19
PIECES = "_id bigint, piece int, start bigint, length int, ids_crc32 bigint, ids binary, block int, nth bigint"


class RoomTree:
    """Segment tree over rooms 0 .. capacity: how many open bins have each, and the least room of at least n."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, bins: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room >= ``need`` with an open bin."""
        at = need + self.size
        if self.count[at]:
            return need
        while at > 1:       # up to the first right neighbour with a bin, then down to its leftmost one
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


@dataclass(frozen=True)
class Step:
    """Pieces of ``length`` with ranks from ``rank``: ``copies`` side by side from ``offset`` in each of ``bins`` bins from ``first_bin``."""

    length: int
    rank: int
    copies: int
    first_bin: int
    bins: int
    offset: int


def plan_bins(histogram: dict[int, int], capacity: int) -> list[Step]:
    """The steps of best-fit decreasing for so many pieces of each length."""
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must be within 1 and {capacity}")
    tree, open_bins = RoomTree(capacity), defaultdict(deque)     # room -> runs of bins (first, number)
    steps, made = [], 0

    def put(room: int, first: int, bins: int) -> None:
        if room and bins:
            open_bins[room].append((first, bins))
            tree.add(room, bins)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, bins = capacity, made, -(-left // (capacity // length))
                made += bins
            else:
                first, bins = open_bins[room].popleft()
                tree.add(room, -bins)
            copies = room // length
            full = min(bins, left // copies)
            rest = min(left - full * copies, copies - 1) if full < bins else 0
            for n, each, start in ((full, copies, first), (1, rest, first + full)):
                if n and each:
                    steps.append(Step(length, rank, each, start, n, capacity - room))
                    put(room - each * length, start, n)
                    rank, left = rank + n * each, left - n * each
            used = full + bool(rest)
            if used < bins:     # untouched bins stay the first of their room
                open_bins[room].appendleft((first + used, bins - used))
                tree.add(room, bins - used)
    return steps


def _cut(tokenizer_path: str, end_id: int | None, capacity: int, keep_ids: bool):
    fields = [("_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
              ("ids_crc32", pa.int64()), ("ids", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        encoder = worker_encoder(tokenizer_path)
        seen = np.zeros(capacity + 1, np.int64)     # pieces of each length so far in this block
        for doc_ids, texts in text_chunks(batches, CHUNK_CHARS):
            flat, counts = encoder.encode(texts)
            if end_id is not None:
                flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
            flat = flat.astype("<u4")
            rows: list[tuple] = []
            at = 0
            for doc, n in zip(doc_ids, counts.tolist(), strict=True):
                for k, start in enumerate(range(0, n, capacity)):
                    ids = flat[at + start:at + min(start + capacity, n)]
                    rows.append((doc, k, start, len(ids), crc32_u32(ids), ids.tobytes() if keep_ids else None))
                at += n
            if not rows:
                continue
            columns = list(zip(*rows, strict=True))
            length = np.array(columns[3], np.int64)
            order = np.argsort(length, kind="stable")
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.searchsorted(length[order], length[order])
            nth += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, (_, t) in zip(columns, fields, strict=True)]
                + [pa.array(np.full(len(length), block), pa.int32()), pa.array(nth)], names=[*(n for n, _ in fields), "block", "nth"])
    return run


def _place(steps: list[Step], names: list[str]):
    by_length: dict[int, list[Step]] = defaultdict(list)
    for s in steps:
        by_length[s.length].append(s)
    tables = {k: np.array([(s.rank, s.copies, s.first_bin, s.offset) for s in v], np.int64) for k, v in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for hit in np.split(order, cuts) if len(order) else []:
                k = int(length[hit[0]])
                first, copies, first_bin, start = tables[k][np.searchsorted(tables[k][:, 0], rank[hit], "right") - 1].T
                within = rank[hit] - first
                sequence[hit], offset[hit] = first_bin + within // copies, start + within % copies * k
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])
    return run


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int | None = 0, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``id_col``, piece (from 0 in its document), start, length, ids_crc32, ids (little-endian
    unsigned 32-bit; null unless ``keep_ids``), sequence_id (from 0, no gap), offset.
    """
    pieces = stored(id_and_text(df, id_col, text_col).mapInArrow(
        trimmed(_cut(tokenizer_path, end_id, capacity, keep_ids)), PIECES), "fit_pieces")
    # pieces of a length in each block, and how many lie in blocks before it
    per_block = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = per_block.select("length", "block", (F.sum("n").over(
        W.partitionBy("length").orderBy("block")) - F.col("n")).alias("before"))
    # one row per length: at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan_bins(histogram, capacity)
    ranked = pieces.join(before, ["length", "block"]).select(
        "_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "ids",
        (F.col("nth") + F.col("before")).alias("rank"))
    placed = ranked.mapInArrow(trimmed(_place(steps, ranked.columns)), f"{_types(ranked)}, sequence_id bigint, offset bigint")
    return placed.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


def _types(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)
