"""Removal of repeated strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in another text or the same, is removed (all occurrences; overlaps count; the strings are
those of the input).

1. Equal texts are one text with a number of copies.
2. Candidates.  Every window of ``length`` bytes has an anchor: the smallest
   hash among its grams.  Equal windows have equal anchors at equal places, so a
   window whose anchor occurs nowhere else is unique.  Windows that follow each other with the
   same anchor form a context.  Contexts that occur twice as a whole are repeats as
   they stand.
3. Suffix arrays.  What is left, one example of each different context of an anchor that
   has several, is dealt into shards by anchor.  A shard sorts its suffixes by
   Larsson-Sadakane refinement (only groups still equal are sorted again, on
   the rank of what follows) and computes Kasai's common
   prefixes, for all contexts in step.  An anchor with very many contexts
   goes to several shards; the windows of one are looked up in the suffix
   array of the other by binary search.
4. The repeated windows are merged to spans and cut out.

Null texts are empty; texts shorter than ``length`` stay whole; null or
repeated ids are rows like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import (U64, discard, id_and_text, in_blocks, mix, shuffle_partitions, stored, stored_by_key,
                                  trimmed, whole_groups, written)

SEGMENT = 1 << 18           # bytes of text hashed at once
PLACE_BITS = U64(22)        # place within a chunk of segments, below the hash that orders grams
SHARD_BYTES = 1 << 21       # bytes in one suffix array
ANCHOR_CONTEXTS = 1024      # more contexts of one anchor go to pairs of blocks
ANCHOR = "key binary, copies bigint, g bigint, first bigint, last bigint, h1 bigint, h2 bigint"

_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, ...]:
    """Powers of two odd bases and of their inverses modulo 2**64, and the byte values."""
    if len(_tables.get("p0", ())) < n:
        for k, base in enumerate((0xD6E8FEB86659FD93, 0xA0761D6478BD642F)):
            for name, b in ((f"p{k}", base), (f"q{k}", pow(base, -1, 1 << 64))):
                powers = np.full(n, U64(b))
                powers[0] = 1
                _tables[name] = np.cumprod(powers, dtype=U64)
        _tables["bytes"] = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return tuple(_tables[k] for k in ("p0", "q0", "p1", "q1", "bytes"))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of values[i : i + width] for every i that has so many (block prefix and suffix minima)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def chunk_contexts(segments: list[bytes], length: int, gram: int) -> dict[str, np.ndarray]:
    """Contexts of the windows of all segments: segment, first and last window (from the
    segment's start), hash of the anchor's gram, two hashes of the context."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    n, width = len(data), length - gram + 1
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    p0, q0, p1, q1, values = _powers(max(n + 1, 2 * SEGMENT + 4096))
    v = values[data]
    sum0, sum1 = (np.append(U64(0), np.cumsum(v * p[:n], dtype=U64)) for p in (p0, p1))
    grams = mix((sum0[gram:] - sum0[:-gram]) * q0[:n - gram + 1])
    place = np.arange(len(grams), dtype=U64)
    lowest = _window_min((grams >> PLACE_BITS << PLACE_BITS) | place, width)
    anchor = (lowest & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(segments)), sizes)[:len(anchor)]
    valid = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
    new = np.append(True, (np.diff(anchor[valid]) != 0) | (np.diff(valid) != 1)) if len(valid) else np.zeros(0, bool)
    first = valid[new]
    last = valid[np.append(np.flatnonzero(new)[1:] - 1, len(valid) - 1)] if len(valid) else first
    stop = last + length
    base = (ends - sizes)[owner[first]]
    return {"segment": owner[first], "first": first - base, "last": last - base, "g": grams[anchor[first]],
            "h1": mix((sum0[stop] - sum0[first]) * q0[first] + (last - first).astype(U64)),
            "h2": mix((sum1[stop] - sum1[first]) * q1[first] ^ (first - anchor[first]).astype(U64))}


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list) -> pa.RecordBatch:
            c = chunk_contexts([s for *_, s in held], length, gram)
            at = c["segment"]
            base = np.array([h[2] for h in held], np.int64)[at]
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.binary()).take(pa.array(at)),
                 pa.array(np.array([h[1] for h in held], np.int64)[at]), pa.array(c["g"].view(np.int64)),
                 pa.array(c["first"] + base), pa.array(c["last"] + base), pa.array(c["h1"].view(np.int64)),
                 pa.array(c["h2"].view(np.int64))], names=["key", "copies", "g", "first", "last", "h1", "h2"])

        held: list[tuple[bytes, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for k in range(batch.num_rows):
                key, copies, text = (batch.column(c)[k].as_py() for c in range(3))
                raw = text.encode()
                for start in range(0, len(raw) - length + 1, SEGMENT):
                    held.append((key, copies, start, raw[start:start + SEGMENT + length - 1]))
                    size += len(held[-1][3])
                    if size >= SEGMENT:
                        yield emit(held)
                        held, size = [], 0
        if held:
            yield emit(held)
    return run


def _with_bytes(length: int):
    """Contexts with their bytes, from the text they lie in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("g", "key", "first", "weight", "context")}
            for row in batch.to_pylist():
                raw = row["text"].encode()
                for c in row["contexts"]:
                    for k, v in (("g", c["g"]), ("key", row["key"]), ("first", c["first"]), ("weight", c["weight"]),
                                 ("context", raw[c["first"]:c["last"] + length])):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()),
                                                strict=True)], names=list(out))
    return run


class SuffixArray:
    """Suffixes of some byte strings, sorted.

    ``order`` holds the suffixes ascending, ``rank`` the first place in it of
    a suffix's group of equal ones.  A suffix ends with its string; equal
    suffixes stay in the strings' order, which Kasai's bound needs.  ``depth``
    caps the common prefixes.
    """

    def __init__(self, strings: list[bytes], depth: int):
        self.depth = depth
        joined = b"".join(strings) + bytes(8)
        self.data = np.frombuffer(joined, np.uint8)[:-8]
        n = len(self.data)
        # the eight bytes from every place
        self.lanes = np.ndarray((n,), "<u8", joined, strides=(1,))
        sizes = np.array([len(s) for s in strings], np.int32)
        ends = np.cumsum(sizes, dtype=np.int32)
        self.starts, self.sizes = ends - sizes, sizes
        self.end = np.repeat(ends, sizes)
        # the first seven bytes, then how many of them there are
        key = self.lanes.byteswap() >> U64(8) << U64(3) | U64(7)
        tail = np.concatenate([ends[sizes >= k] - k for k in range(1, 7)]) if n else ends[:0]
        held = (self.end[tail] - tail).astype(U64)
        spare = U64(8) * (U64(7) - held) + U64(3)
        key[tail] = key[tail] >> spare << spare | held
        self.order = np.argsort(key).astype(np.int32)
        self.rank = np.empty(n, np.int32)
        known, longest = 7, int(sizes.max(initial=0))
        slots, keys = np.arange(n, dtype=np.int32), key[self.order]   # places in ``order`` that are still open, and their sort keys
        while True:
            new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            sizes_of = np.diff(np.append(first, len(keys)))
            self.rank[self.order[slots]] = np.repeat(slots[first], sizes_of)
            slots = slots[np.repeat(sizes_of > 1, sizes_of)]
            suffix = self.order[slots]
            if known >= longest or not len(slots):
                break
            after = suffix + np.int32(known)
            inside = after < self.end[suffix]
            following = np.where(inside, self.rank[np.where(inside, after, 0)] + 1, 0)
            keys = self.rank[suffix] * np.int64(n + 1) + following
            resort = np.argsort(keys, kind="stable")
            keys = keys[resort]
            self.order[slots] = suffix[resort]
            known *= 2
        # suffixes that are equal to their ends, in the strings' order
        self.order[slots] = suffix[np.argsort(self.rank[suffix] * np.int64(n + 1) + suffix)]

    def common_prefixes(self) -> np.ndarray:
        """Kasai: bytes (``depth`` at most) that each place of ``order`` shares with the one before.

        All strings advance in step, one suffix each at a time; the common
        prefix of a string's next suffix is at most one shorter.  Bytes are compared eight at a time.
        """
        n = len(self.data)
        place = np.empty(n, np.int32)
        place[self.order] = np.arange(n, dtype=np.int32)
        out = np.zeros(n, np.int32)
        live = np.flatnonzero(self.sizes > 0)
        shared = np.zeros(len(live), np.int32)
        for step in range(int(self.sizes.max(initial=0))):
            keep = self.sizes[live] > step
            if not keep.all():
                live, shared = live[keep], shared[keep]
            suffix = self.starts[live] + np.int32(step)
            at = place[suffix]
            before = self.order[np.maximum(at - 1, 0)]
            room = np.minimum(np.minimum(self.end[suffix] - suffix, self.end[before] - before), self.depth)
            room[at == 0] = 0
            shared = np.minimum(np.maximum(shared - 1, 0), room)
            grow = np.flatnonzero(shared < room)
            while len(grow):
                from_ = shared[grow]
                differ = self.lanes[suffix[grow] + from_] ^ self.lanes[before[grow] + from_]
                # equal bytes at the front: those below the lowest bit that differs
                from_ += (np.bitwise_count((differ & (~differ + U64(1))) - U64(1)) >> 3).astype(np.int32)
                shared[grow] = np.minimum(from_, room[grow])
                grow = grow[(differ == 0) & (from_ < room[grow])]
            out[at] = shared
        return out

    def repeated(self) -> np.ndarray:
        """Whether the ``depth`` bytes from each place occur twice."""
        shared = self.common_prefixes() >= self.depth
        hit = np.empty(len(shared), bool)
        hit[self.order] = shared | np.append(shared[1:], False)
        return hit

    def contains(self, data: np.ndarray, starts: np.ndarray, part: int = 1 << 14) -> np.ndarray:
        """Whether the ``depth`` bytes of ``data`` from each start occur here (binary search)."""
        whole = self.order[self.end[self.order] - self.order >= self.depth]
        found = np.zeros(len(starts), bool)
        offsets = np.arange(self.depth)
        for k in range(0, len(starts) if len(whole) else 0, part):
            query = data[starts[k:k + part, None] + offsets]
            low, high = np.zeros(len(query), np.int64), np.full(len(query), len(whole))
            while (low < high).any():
                mid = np.minimum((low + high) // 2, len(whole) - 1)
                there = self.data[whole[mid][:, None] + offsets]
                differ = there != query
                at = differ.argmax(axis=1)
                rows = np.arange(len(query))
                equal = ~differ[rows, at]
                found[k:k + part] |= equal & (low < high)
                less = there[rows, at] < query[rows, at]
                low, high = np.where((low < high) & less, mid + 1, low), np.where((low < high) & ~less, mid, high)
        return found


def _repeats(length: int):
    def spans(table: pa.Table, strings: list[bytes], hit: np.ndarray) -> pa.RecordBatch | None:
        """``hit``: for every byte of the strings, whether the window from it is repeated."""
        sizes = np.array([len(s) for s in strings], np.int64)
        owner = np.repeat(np.arange(len(strings)), sizes)
        edge = hit & np.append(True, ~hit[:-1] | (owner[1:] != owner[:-1]))
        tail = hit & np.append(~hit[1:] | (owner[1:] != owner[:-1]), True)
        a, b = np.flatnonzero(edge), np.flatnonzero(tail)
        who = owner[a]
        base = table.column("first").to_numpy()[who] - (np.cumsum(sizes) - sizes)[who]
        return pa.RecordBatch.from_arrays(
            [table.column("key").combine_chunks().take(pa.array(who)), pa.array(a + base), pa.array(b + base + length)],
            names=["key", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def within(held: list[pa.Table]) -> pa.RecordBatch:
            table = pa.concat_tables(held)
            strings = table.column("context").to_pylist()
            return spans(table, strings, SuffixArray(strings, length).repeated())

        def across(table: pa.Table) -> Iterator[pa.RecordBatch]:
            second = table.column("second").to_numpy(zero_copy_only=False).astype(bool)
            sides = [table.filter(pa.array(second == s)) for s in (False, True)]
            texts = [t.column("context").to_pylist() for t in sides]
            for mine, other in ((0, 1), (1, 0)):
                if texts[mine] and texts[other]:
                    there = SuffixArray(texts[other], length)
                    sizes = np.array([len(s) for s in texts[mine]], np.int64)
                    ends = np.repeat(np.cumsum(sizes), sizes)
                    starts = np.flatnonzero(np.arange(len(ends)) + length <= ends)
                    hit = np.zeros(len(ends), bool)
                    hit[starts] = there.contains(np.frombuffer(b"".join(texts[mine]), np.uint8), starts)
                    yield spans(sides[mine], texts[mine], hit)

        held: list[pa.Table] = []
        size = 0
        for table in whole_groups(batches, 3):
            g, lo, hi = (table.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
            for b, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(g)], strict=True):
                part = table.slice(b, e - b)
                if lo[b] != hi[b]:
                    yield from across(part)
                    continue
                held.append(part)
                size += part.column("context").nbytes
                if size >= SHARD_BYTES:
                    yield within(held)
                    held, size = [], 0
        if held:
            yield within(held)
    return run


def _cut(batches: Iterator[pa.RecordBatch], as_text: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("key", "n_bytes", "spans", "kept")}
        for row in batch.to_pylist():
            raw = row["text"].encode()
            found = [(0, len(raw))] if row["copies"] > 1 else sorted((s["start"], s["stop"]) for s in row["spans"] or [])
            merged: list[list[int]] = []
            for a, b in found:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            # by piece: bytes of two cut characters never make a third
            left = "".join(x.decode(errors="ignore") for x in kept) if as_text else b"".join(kept)
            for k, v in (("key", row["key"]), ("n_bytes", len(raw)), ("kept", left),
                         ("spans", [{"start": a, "stop": b} for a, b in merged])):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(out.values(), (
                pa.binary(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                pa.string() if as_text else pa.binary()),
                strict=True)], names=list(out))


def text_key(text_col):
    """What equal texts share: half of their SHA-256."""
    return F.substring(F.unhex(F.sha2(text_col, 256)), 1, 16)


def repeated_spans(df: DataFrame, length: int = 400, gram: int = 48, id_col: str = "doc_id",
                   text_col: str = "text", as_text: bool = False) -> DataFrame:
    """One row per different text of ``length`` bytes or more: key (see :func:`text_key`), n_bytes,
    spans (start, stop of every maximal removed run, ascending), kept (the bytes left, or with
    ``as_text`` the whole characters left)."""
    tasks = shuffle_partitions(df.sparkSession)
    rows = id_and_text(df, id_col, text_col).filter(F.octet_length("_text") >= length)
    texts = stored_by_key(rows.groupBy(text_key(F.col("_text")).alias("key")).agg(
        F.first("_text").alias("text"), F.count(F.lit(1)).alias("copies")), "texts", "key", tasks)
    # read twice: which anchors occur twice, then their contexts
    contexts, anchors = written(texts.select("key", "copies", "text").mapInArrow(trimmed(_anchors(length, gram)), ANCHOR), "anchors")
    # written, so that the join reads two plain shuffles and a hot anchor can be split
    common = stored(contexts.groupBy("g").agg(F.sum("copies").alias("_w")).filter("_w > 1").select("g"), "common")
    places = stored(contexts.join(common, "g"), "contexts")
    discard(df.sparkSession, anchors)   # the largest table here; only the last two read it
    variants = stored(places.groupBy("g", "h1", "h2").agg(
        F.sum("copies").alias("weight"), F.min(F.struct("key", "first", "last")).alias("at")), "variants")
    whole = places.join(variants.filter("weight > 1"), ["g", "h1", "h2"]).select(
        "key", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    several = variants.groupBy("g").agg(F.count(F.lit(1)).alias("_v"), F.min("weight").alias("_least")).filter(
        "_v > 1 AND _least = 1").select("g")
    examples = variants.join(several, "g").select("at.key", F.struct("g", "at.first", "at.last", "weight").alias("c"))
    with_bytes = texts.select("key", "text").join(
        examples.groupBy("key").agg(F.collect_list("c").alias("contexts")), "key").mapInArrow(
        trimmed(_with_bytes(length)), "g bigint, key binary, first bigint, weight bigint, context binary")
    shards = in_blocks(stored(with_bytes.withColumn("_at", F.xxhash64("key", "first")), "shards"), "g", ANCHOR_CONTEXTS, "_at")
    partly = (shards.repartition(tasks, "g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")
              .select("g", "lo", "hi", "key", "first", "second", "context")
              .mapInArrow(trimmed(_repeats(length)), "key binary, start bigint, stop bigint"))
    spans = whole.unionByName(partly).groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(spans, "key", "left").select("key", "text", "copies", "spans").mapInArrow(
        trimmed(partial(_cut, as_text=as_text)), "key binary, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, "
        + ("kept string" if as_text else "kept binary"))


def remove_repeats(df: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the repeated strings cut out of ``text_col`` (a character cut in part goes too)."""
    found = repeated_spans(df, length, id_col=id_col, text_col=text_col, as_text=True).filter(F.size("spans") > 0)
    changed = found.select(F.col("key").alias("__x_key"), F.col("kept").alias("__x_text"))
    rows = df.withColumn("__x_own", text_key(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.join(changed, F.col("__x_own") == F.col("__x_key"), "left").select(
        *[F.coalesce("__x_text", text_col).alias(text_col) if c == text_col else F.col(c) for c in df.columns])
