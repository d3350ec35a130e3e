"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

1. Each task cuts its texts into blocks and every block into pre-tokens.  A
   block keeps its distinct pre-tokens once (most frequent first) and each
   document as a list of positions into them.
2. The distinct pre-tokens are dealt into buckets by hash; a bucket encodes
   every word once, whatever the number of blocks that hold it.
3. The ids return to their blocks by a join and each document is put together
   again by position.

A very common word is one entry per block, so it is no hot key, and buckets
are even because they are dealt by a hash of the distinct word.  Words are told apart by their letters.
The cut knows the published byte-level pattern; with another pattern, or in a text with code points that
Python's Unicode tables do not know, the whole text is one word, which the library cuts itself.  Null texts count as
empty (no ids); repeated or null document ids are kept as they are, one result
row per input row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import (id_and_text, pack_planes, shuffle_partitions, spans_index, stored_by_key,
                                  text_chunks, trimmed, unpack_planes)
from attrition.llm.pieces import BYTE_LEVEL_PATTERN, odd_text, split

CHUNK_CHARS = 1 << 20
BLOCK_CHARS = 12 << 20

BLOCK_SCHEMA = ("block string, ids array<bigint>, pieces array<int>, sequence binary, buckets binary, "
                "words array<struct<bucket:int, words:binary>>")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _pack_words(words: list[str]) -> bytes:
    data = [w.encode() for w in words]
    sizes = np.array([len(d) for d in data], "<u4")
    return zstandard.ZstdCompressor(level=1).compress(
        np.uint32(len(data)).tobytes() + sizes.tobytes() + b"".join(data))


def _unpack_words(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.append(4 + 4 * n, ends[:-1]) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class _Block:
    """Documents of a block as places in its list of distinct words."""

    def __init__(self, n_buckets: int, whole: bool):
        self.n_buckets, self.whole = n_buckets, whole   # whole: each text is one word
        self.index: dict[str, int] = {}
        self.words: list[str] = []
        self.bucket_of: list[int] = []
        self.ids: list = []
        self.pieces: list[int] = []
        self.parts: list[np.ndarray] = []
        self.chars = 0

    def place(self, word: str) -> int:
        at = self.index.get(word)
        if at is None:
            at = self.index[word] = len(self.words)
            self.words.append(word)
            self.bucket_of.append(zlib.crc32(word.encode()) % self.n_buckets)
        return at

    def add(self, ids: list, texts: list[str]) -> None:
        single = {k for k, t in enumerate(texts) if t and (self.whole or odd_text(t))}
        parts = split(["" if k in single else t for k, t in enumerate(texts)] if single else texts)
        self.ids += ids
        self.chars += sum(map(len, texts))
        counts = parts.per_doc.copy()
        places = np.zeros(0, np.int32)
        if len(parts.starts):
            first, inverse, _ = parts.distinct()
            places = np.array([self.place(w) for w in parts.strings(first)], np.int32)[inverse]
        if single:
            at = sorted(single)
            before = (np.cumsum(counts) - counts)[at]
            places = np.insert(places, before, [self.place(texts[k]) for k in at])
            counts[at] = 1
        self.pieces += counts.tolist()
        self.parts.append(places)

    def row(self) -> dict:
        n, n_buckets = len(self.words), self.n_buckets
        places = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        by_freq = np.argsort(-np.bincount(places, minlength=n), kind="stable")
        rank = np.empty(n, np.uint32)
        rank[by_freq] = np.arange(n, dtype=np.uint32)
        bucket = np.array(self.bucket_of, np.int64)[by_freq] if n else np.zeros(0, np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        words = [{"bucket": b, "words": _pack_words([self.words[by_freq[k]] for k in order[cuts[b]:cuts[b + 1]]])}
                 for b in range(n_buckets) if cuts[b] < cuts[b + 1]]
        return {"block": uuid.uuid4().hex, "ids": self.ids, "pieces": self.pieces, "sequence": pack_planes(rank[places]),
                "buckets": pack_planes(bucket), "words": words}


def _block_batches(n_buckets: int, block_chars: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(n_buckets, whole)

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([block.row()], schema)

        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            block.add(ids, texts)
            if block.chars >= block_chars:
                yield emit()
                block = _Block(n_buckets, whole)
        if block.ids:
            yield emit()

    schema = pa.schema([
        ("block", pa.string()), ("ids", pa.list_(pa.int64())), ("pieces", pa.list_(pa.int32())),
        ("sequence", pa.binary()), ("buckets", pa.binary()),
        ("words", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])))])
    return run


def _encode_buckets(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path),
                                     special_tokens={})
        known: dict[bytes, list[int]] = {}
        current = None
        for batch in batches:
            out = []
            for block, bucket, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if bucket != current:  # rows come sorted by bucket
                    known, current = {}, bucket
                words = _unpack_words(blob)
                for w in words:
                    if w not in known:
                        known[w] = encoding.encode_ordinary(w.decode())
                found = [known[w] for w in words]
                sizes = [len(x) for x in found]
                flat = np.fromiter((i for x in found for i in x), np.int64, sum(sizes))
                out.append({"block": block, "bucket": bucket, "sizes": pack_planes(np.array(sizes)),
                            "tokens": pack_planes(flat)})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    ("block", pa.string()), ("bucket", pa.int32()), ("sizes", pa.binary()), ("tokens", pa.binary())]))
    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            bucket = unpack_planes(row["buckets"])
            answers = sorted(row["answers"] or [], key=lambda a: a["bucket"])
            sizes = np.concatenate([unpack_planes(a["sizes"]) for a in answers] or [np.zeros(0, np.uint32)])
            tokens = np.concatenate([unpack_planes(a["tokens"]) for a in answers] or [np.zeros(0, np.uint32)])
            sizes = sizes.astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            at = np.empty(len(bucket), np.int64)    # word by frequency -> its place in bucket order
            at[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
            sequence = at[unpack_planes(row["sequence"])]
            pieces = np.append(0, np.cumsum(np.array(row["pieces"], np.int64)))
            lo = 0
            while lo < len(row["ids"]):  # a few documents at a time
                hi = max(lo + 1, int(np.searchsorted(pieces, pieces[lo] + CHUNK_CHARS, "right")) - 1)
                seq = sequence[pieces[lo]:pieces[hi]]
                flat = tokens[spans_index(starts[seq], sizes[seq])].astype(np.int32)
                ends = np.append(0, np.cumsum(sizes[seq]))[pieces[lo:hi + 1] - pieces[lo]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"][lo:hi], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], names=["_id", "tokens"])
                lo = hi


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           n_buckets: int | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``id_col`` and ``tokens`` (array of ids).

    The blocks are written once, bucketed by block, so only the answers are
    shuffled to meet them.

    ``n_buckets`` is the number of word buckets; a bucket holds its distinct
    words in memory, so raise it with the vocabulary (default: the session's
    shuffle partitions, 64 at least).
    """
    n_buckets = n_buckets or max(64, shuffle_partitions(df.sparkSession))
    blocks = stored_by_key(id_and_text(df, id_col, text_col).mapInArrow(
        trimmed(_block_batches(n_buckets, block_chars, pattern != BYTE_LEVEL_PATTERN)), BLOCK_SCHEMA), "bpe_blocks", "block", n_buckets)
    answers = (blocks.select("block", F.explode("words").alias("w")).select("block", "w.bucket", "w.words")
               .repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(trimmed(_encode_buckets(ranks_path, pattern)),
                           "block string, bucket int, sizes binary, tokens binary")
               .groupBy("block").agg(F.collect_list(F.struct("bucket", "sizes", "tokens")).alias("answers")))
    return (blocks.drop("words").join(answers, "block", "left")
            .mapInArrow(trimmed(_assemble), "_id bigint, tokens array<int>")
            .withColumnRenamed("_id", id_col))


def _decode_batches(ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = sorted((r, t) for t, r in read_ranks(ranks_path).items())
        table = [b""] * (by_rank[-1][0] + 1)
        for r, t in by_rank:
            table[r] = t
        sizes = np.array([len(t) for t in table], np.int64)
        data = np.frombuffer(b"".join(table), np.uint8)
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            width = sizes[ids]
            text = data[spans_index(starts[ids], width)]
            ends = np.append(0, np.cumsum(width))[np.append(0, np.cumsum(counts))]
            decoded = pa.Array.from_buffers(pa.large_binary(), len(counts), [
                None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, decoded], names=["_id", "tokens", "decoded"])
    return run


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``id_col``, ``tokens`` and ``decoded``: the bytes of the ids.

    Each id is joined with the token-byte table, which is as large as the
    vocabulary (a fixed bound), so the join needs no shuffle.  Null tokens
    decode to no bytes.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(tokens_col).alias("tokens"))
    return rows.mapInArrow(trimmed(_decode_batches(ranks_path)), "_id bigint, tokens array<int>, decoded binary").withColumnRenamed(
        "_id", id_col)
