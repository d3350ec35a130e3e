"""Token-id shards compressed by a Re-Pair grammar.

Documents are dealt into ranges of ascending id; each range writes its tokens
as segments.  Inside a segment, rounds replace pairs of neighbouring ids by
new symbols, the more frequent of two that overlap first, until no pair occurs
twice.  A segment keeps its rules and every symbol's expansion length, so that
one document, or any range of tokens, is decoded without the rest.

File format (Parquet, one row per segment, ascending in shard and segment):
``shard``, ``segment``, ``doc_ids``, ``doc_tokens`` (ids per document, end id
included), ``n_ids`` (ids before the first rule symbol), ``rules`` (pairs of
symbols, 32-bit little-endian), ``expansions`` (length of each rule symbol),
``rounds`` (rules after each round), ``symbols`` (the compressed sequence).

Null texts are empty (the end id alone); repeated documents stay separate and
are ordered by id, then by text hash; null ids come first.  An empty table
gives empty files.  A hot id is spread over ranges by the text hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from attrition.llm.common import crc32_u32, id_and_text, pack_planes, shuffle_partitions, spans_index, text_chunks, unpack_planes
from attrition.llm.pieces import worker_encoder
from attrition.sources.files import shared_dir

CHUNK_CHARS = 1 << 19
SPELT = 64          # ids of a rule that are written out whole when a segment is read

SEGMENT = ("shard int, segment int, doc_ids array<bigint>, doc_tokens array<bigint>, n_ids bigint, rules binary, "
           "expansions binary, rounds array<int>, symbols binary")
SEGMENT_ARROW = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("rules", pa.binary()), ("expansions", pa.binary()),
    ("rounds", pa.list_(pa.int32())), ("symbols", pa.binary())])


def _runs(pair: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of their pairs, where each pair begins in that order, how many it has."""
    at_bits = max(len(pair) - 1, 1).bit_length()
    if 2 * bits + at_bits <= 64:    # pair and place sorted as one number
        both = pair.astype(np.uint64) << np.uint64(at_bits)
        both |= np.arange(len(pair), dtype=np.uint64)
        both.sort()
        order = (both & np.uint64((1 << at_bits) - 1)).view(np.int64)
        both >>= np.uint64(at_bits)
    else:
        order = np.argsort(pair, kind="stable")
        both = pair[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    return order, first, np.diff(np.append(first, len(pair)))


def compress(ids: np.ndarray) -> dict:
    """Grammar of a sequence of ids: n_ids, rules (n x 2), expansions, rounds, symbols.

    At the end no pair of neighbouring symbols occurs twice without overlap.  A round counts every such pair exactly
    and replaces it wherever it is more frequent than the pairs that overlap it there, if it has two such places.  Pairs
    that occur once leave the count until one of their symbols changes: only a rule makes further pairs.
    """
    symbols = np.asarray(ids, np.int32)     # a segment has fewer symbols than 2**31
    n_ids = int(symbols.max(initial=-1)) + 1
    rules, marks, next_symbol = [np.zeros((0, 2), np.int64)], [], n_ids
    open_ = np.arange(len(symbols) - 1)     # places whose pair may occur twice, ascending
    while len(open_):
        left, right = symbols[open_], symbols[open_ + 1]
        touching = np.diff(open_) == 1      # the next open pair overlaps this one
        # of a run of one symbol, every other pair from its left end
        doubled = left == right
        chain = np.flatnonzero(touching & doubled[1:] & doubled[:-1]) + 1
        step = np.arange(len(chain))
        skipped = chain[(step - np.maximum.accumulate(np.where(np.diff(chain, prepend=-1) > 1, step, 0))) % 2 == 0]
        bits = max(next_symbol, len(skipped)).bit_length()
        pair = left.astype(np.int64) << bits
        pair |= right
        pair[skipped] = (1 << bits) - 1 << bits | np.arange(len(skipped))   # no symbol's number: occurs once
        order, first, count = _runs(pair, bits)
        frequent = np.flatnonzero(count > 1)
        if not len(frequent):
            break
        # every pair's rank by frequency, from 1; 0: occurs once, or is not counted
        of_run = np.zeros(len(first), np.int32)
        of_run[frequent[np.argsort(count[frequent], kind="stable")]] = np.arange(1, len(frequent) + 1, dtype=np.int32)
        rank = np.empty(len(open_), np.int32)
        rank[order] = np.repeat(of_run, count)
        top = rank > 0
        still = top.copy()
        still[skipped] = True
        above = rank[1:] > rank[:-1]
        top[:-1] &= ~(touching & above)
        top[1:] &= ~touching | above
        places = np.flatnonzero(top)
        rule = rank[places]
        used = np.bincount(rule, minlength=len(frequent) + 1) > 1
        rule = np.where(used, np.cumsum(used) - 1, -1)[rule]
        places, rule = places[rule >= 0], rule[rule >= 0]
        made = np.empty((int(used.sum()), 2), np.int64)
        made[rule, 0], made[rule, 1] = left[places], right[places]
        start = open_[places]
        symbols = symbols if len(rules) > 1 else symbols.copy()     # the caller's ids stay
        symbols[start] = next_symbol + rule
        rules.append(made)
        next_symbol += len(made)
        marks.append(next_symbol - n_ids)
        # still open: pairs that occur twice or were not counted, and those beside a new symbol
        keep, near = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        keep[start + 1] = False
        near[open_] = still
        near[start] = near[np.maximum(start - 1, 0)] = True
        symbols, open_ = symbols[keep], np.flatnonzero(near[keep])
        if len(open_) and open_[-1] == len(symbols) - 1:
            open_ = open_[:-1]
    made = np.concatenate(rules)
    return {"n_ids": n_ids, "rules": made, "expansions": _sizes(n_ids, made, marks)[n_ids:], "rounds": marks,
            "symbols": symbols}


def _sizes(n_ids: int, rules: np.ndarray, rounds: list[int]) -> np.ndarray:
    """Ids that each symbol stands for: a rule holds symbols of earlier rounds only."""
    sizes = np.ones(n_ids + len(rules), np.int64)
    for low, high in zip([0, *rounds], rounds):
        sizes[n_ids + low:n_ids + high] = sizes[rules[low:high, 0]] + sizes[rules[low:high, 1]]
    return sizes


def expand(symbols: np.ndarray, n_ids: int, rules: np.ndarray, rounds: list[int]) -> np.ndarray:
    """The ids of ``symbols``: rules of up to ``SPELT`` ids are written out once, longer ones give way to their two sides."""
    symbols, sizes = np.asarray(symbols, np.int64), _sizes(n_ids, rules, rounds)
    short = np.flatnonzero(sizes <= SPELT)
    start = np.zeros(len(sizes), np.int64)
    start[short] = np.cumsum(sizes[short]) - sizes[short]
    spelt = np.arange(int(sizes[short].sum()))      # the ids themselves come first
    for low, high in zip([0, *rounds], rounds):
        made = low + np.flatnonzero(sizes[n_ids + low:n_ids + high] <= SPELT)
        if len(made):
            sides = rules[made].ravel()
            first, last = start[n_ids + made[0]], start[n_ids + made[-1]] + sizes[n_ids + made[-1]]
            spelt[first:last] = spelt[spans_index(start[sides], sizes[sides])]
    place, done = np.cumsum(sizes[symbols]) - sizes[symbols], []
    while (long := sizes[symbols] > SPELT).any():
        done.append((symbols[~long], place[~long]))
        place = place[long]
        left, right = rules[symbols[long] - n_ids].T
        symbols, place = np.concatenate([left, right]), np.concatenate([place, place + sizes[left]])
    if done:
        symbols, place = (np.concatenate([x, *y]) for x, y in zip((symbols, place), zip(*done)))
        symbols = symbols[np.argsort(place)]
    return spelt[spans_index(start[symbols], sizes[symbols])]


def read_range(segment: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` .. ``stop`` of a stored segment: only the symbols that hold them are expanded."""
    n_ids, rules = segment["n_ids"], unpack_planes(segment["rules"]).reshape(-1, 2).astype(np.int64)
    sizes = np.append(np.ones(n_ids, np.int64), unpack_planes(segment["expansions"]))
    symbols = unpack_planes(segment["symbols"]).astype(np.int64)
    ends = np.cumsum(sizes[symbols])
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    begin = int(ends[lo] - sizes[symbols[lo]]) if lo < len(ends) else 0
    return expand(symbols[lo:hi], n_ids, rules, segment["rounds"])[start - begin:stop - begin]


def _segments(tokenizer_path: str, end_id: int, segment_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        encoder = worker_encoder(tokenizer_path)
        doc_ids: list = []
        counts: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            made = compress(np.concatenate(parts))
            row = {"shard": shard, "segment": number, "doc_ids": doc_ids, "doc_tokens": counts, "n_ids": made["n_ids"],
                   "rounds": made["rounds"]} | {k: pack_planes(made[k].ravel()) for k in ("rules", "expansions", "symbols")}
            return pa.RecordBatch.from_pylist([row], SEGMENT_ARROW)

        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            flat, n = encoder.encode(texts)
            ends = np.cumsum(n)
            parts.append(np.insert(flat, ends, end_id))
            doc_ids += ids
            counts += (n + 1).tolist()
            size += len(parts[-1])
            if size >= segment_tokens:
                yield segment()
                doc_ids, counts, parts, size, number = [], [], [], 0, number + 1
        if doc_ids:
            yield segment()
    return run


def write_shards(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", n_shards: int | None = None, segment_tokens: int = 2 << 20) -> str:
    """Tokenize, compress and write ``df`` in ascending id order; returns ``path``."""
    n = n_shards or shuffle_partitions(df.sparkSession)
    rows = id_and_text(df, id_col, text_col).withColumn("_tie", F.xxhash64("_text"))
    (rows.repartitionByRange(n, F.col("_id").asc_nulls_first(), "_tie")
     .sortWithinPartitions(F.col("_id").asc_nulls_first(), "_tie").select("_id", "_text")
     .mapInArrow(_segments(tokenizer_path, end_id, segment_tokens), SEGMENT)
     .write.mode("overwrite").option("compression", "uncompressed").parquet(path))
    return path


def _documents(keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = expand(unpack_planes(row["symbols"]), row["n_ids"],
                             unpack_planes(row["rules"]).reshape(-1, 2).astype(np.int64), row["rounds"]).astype("<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                parts = [ids[a:b] for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([crc32_u32(x) for x in parts], pa.int64()),
                     pa.array([x.tobytes() for x in parts], pa.binary()) if keep_ids else pa.nulls(n, pa.binary()),
                     pa.array(np.full(n, row["shard"]), pa.int32()), pa.array(np.full(n, row["segment"]), pa.int32())],
                    names=["_id", "at", "n_tokens", "ids_crc32", "ids", "shard", "segment"])
    return run


def read_shards(spark: SparkSession, path: str, id_col: str = "doc_id", keep_ids: bool = True) -> DataFrame:
    """Every document of the files: ``id_col``, start, n_tokens, ids_crc32, ids (null unless ``keep_ids``), shard, segment."""
    files = spark.read.schema(SEGMENT).parquet(path)
    # one row per segment, by shard; then one row per shard
    sizes = files.select("shard", "segment", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    shard_start = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("shard_start"))
    segment_start = sizes.select("shard", "segment", (F.sum("n").over(
        W.partitionBy("shard").orderBy("segment")) - F.col("n")).alias("segment_start"))
    starts = segment_start.join(shard_start, "shard").select(
        "shard", "segment", (F.col("segment_start") + F.col("shard_start")).alias("before"))
    docs = files.mapInArrow(_documents(keep_ids), "_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint, ids binary, "
                            "shard int, segment int")
    return docs.join(starts, ["shard", "segment"]).select(
        F.col("_id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids",
        "shard", "segment")


def fresh_path(spark: SparkSession) -> str:
    return shared_dir(spark, "llm", "token_shards")
