"""Exact Jaccard join of documents on word n-grams, by regions around pivots.

Regions.  Distances to a few document pivots do not separate unrelated texts
(all are near 1 from all of them), so the first level takes single n-grams as
pivots: under one order of all n-grams, rarest first, a document belongs to
the regions of the first ``n - ceil(t n) + 1`` of its ``n`` n-grams (its window).
Two documents as near as the threshold always share such a region.

Windows.  Inside a region, two documents can be linked only if their distances
to fixed pivot sets agree up to the threshold: the empty set gives their sizes
and 64 cells of the n-gram space give counts whose summed differences never
exceed the symmetric difference (triangle inequality).  What is left joins
documents into clusters.

Recursion.  Clusters are cut into Voronoi regions around document pivots; a
document enters every region whose pivot is at most ``2 e`` farther than its own (``e``: the
largest distance of a link), and regions are cut again or joined exactly, on whole sets.
Pairs already in one component are skipped, so a group of near copies
costs its pivots' comparisons, not all its pairs.  Regions and clusters with
many documents are dealt to many tasks as pairs of blocks.

The order of n-grams: those with a hash below a cut, by the number of documents that hold them,
then the others, by hash.  Any order gives the same links.

Null texts are empty; texts without words are linked with nothing; texts with
fewer words than n have one n-gram, the whole sequence.  Equal sets are one class with its
smallest id.  Links go by row, so rows that repeat an id, or have none, are linked by their own
texts; ids only name components.  A null id keeps its set size and has a null component.  Of a
component stays the smallest id (nulls last, then the smallest text key).  Sets are compared by 64-bit n-gram hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import (U64, id_and_text, in_blocks, mix, shuffle_partitions, stored, text_chunks,
                                  trimmed, whole_groups)
from attrition.llm.components import components
from attrition.llm.suffix import text_key
from attrition.llm.words import doc_numbers, word_hashes

CHUNK_CHARS = 1 << 19
CELLS = 64
REGION_ROWS = 1024          # more rows of a region, or documents of a cluster, go to pairs of blocks
CLUSTER_ROWS = 1024
CLUSTER_BYTES = 1 << 24     # text in a cluster's block
LEAF, PIVOTS = 48, 8
STEP = U64(0x9E3779B97F4A7C15)
PROFILE = "own struct<id:bigint,key:binary>, n int, h1 bigint, h2 bigint, cells binary, n_low int, low array<bigint>, high array<bigint>"
OWN = pa.struct([("id", pa.int64()), ("key", pa.binary())])


def ngram_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-gram hashes of each text, ascending, text by text; size of each set)."""
    words, per_text = word_hashes(texts)
    doc = doc_numbers(per_text)
    ends = np.cumsum(per_text)
    starts = ends - per_text
    if not len(words):
        return words, per_text
    grams = np.zeros(len(words), U64)
    at = np.arange(len(words))
    for k in range(width):
        grams = grams * STEP + words[np.minimum(at + k, len(words) - 1)]
    whole = at + width <= ends[doc]
    hashes, owner = mix(grams[whole]), doc[whole]
    for d in np.flatnonzero((per_text > 0) & (per_text < width)).tolist():
        h = U64(per_text[d])
        with np.errstate(over="ignore"):
            for w in words[starts[d]:ends[d]]:
                h = h * STEP + w
        hashes, owner = np.append(hashes, mix(np.array([h ^ STEP], U64))), np.append(owner, d)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))
    hashes, owner = hashes[new], owner[new]
    return hashes, np.bincount(owner, minlength=len(texts))


def _profiles(width: int, num: int, den: int, cut: int):
    """``cut``: n-grams with smaller hashes are counted; about 1.5 windows of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, CHUNK_CHARS):
            hashes, sizes = ngram_sets(texts, width)
            ends = np.cumsum(sizes)
            owner = doc_numbers(sizes)
            cells = np.minimum(np.bincount(owner * CELLS + (hashes & U64(CELLS - 1)).astype(np.int64),
                                           minlength=len(texts) * CELLS), 255).astype(np.uint8).reshape(-1, CELLS)
            low = hashes < U64(cut)
            n_low = np.bincount(owner[low], minlength=len(texts))
            h1, h2 = (np.zeros(len(texts), U64) for _ in range(2))
            if len(hashes):
                held = sizes > 0
                first = (ends - sizes)[held]
                h1[held], h2[held] = np.add.reduceat(mix(hashes + U64(1)), first), np.add.reduceat(mix(~hashes), first)
            lows, highs = [], []
            signed = hashes.view(np.int64)
            for b, n, m in zip((ends - sizes).tolist(), sizes.tolist(), n_low.tolist(), strict=True):
                window = n - -(-num * n // den) + 1 if n else 0
                lows.append(signed[b:b + m])
                highs.append(signed[b + m:b + max(m, window)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, OWN), pa.array(sizes.astype(np.int32)), pa.array(h1.view(np.int64)),
                 pa.array(h2.view(np.int64)), pa.array([c.tobytes() for c in cells], pa.binary()),
                 pa.array(n_low.astype(np.int32)), pa.array(lows, pa.list_(pa.int64())),
                 pa.array(highs, pa.list_(pa.int64()))],
                names=["own", "n", "h1", "h2", "cells", "n_low", "low", "high"])
    return run


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _region_edges(num: int, den: int):
    """Pairs inside a region that the windows leave, thinned to what connects the same documents."""
    def near(n: np.ndarray, cells: np.ndarray, a, b) -> np.ndarray:
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        ok = num * large <= den * small
        apart = np.abs(cells[a].astype(np.int16) - cells[b]).sum(axis=-1)
        return ok & ((den + num) * apart <= (den - num) * (small + large))

    def connect(n: np.ndarray, cells: np.ndarray, second: np.ndarray, cross: bool) -> list[tuple[int, int]]:
        edges, left = [], np.ones(len(n), bool)
        queue: list[int] = []
        while queue or left.any():
            if not queue:
                queue = [int(np.flatnonzero(left)[0])]
                left[queue[0]] = False
            p = queue.pop()
            rest = np.flatnonzero(left & (second != second[p]) if cross else left)
            hit = rest[near(n, cells, p, rest)] if len(rest) else rest
            left[hit] = False
            edges += [(p, x) for x in hit.tolist()]
            queue += hit.tolist()
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            s, lo, hi, n, ids, second = (_numbers(table, x) for x in ("s", "lo", "hi", "n", "_id", "second"))
            cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS)
            n = n.astype(np.int64)
            new = np.append(True, (s[1:] != s[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(s)))
            group_size = np.repeat(size, size)
            position = np.arange(len(s)) - np.repeat(start, size)
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            small = group_size <= LEAF
            for d in range(1, int(size[size <= LEAF].max(initial=1))):
                a = np.flatnonzero(small & (position + d < group_size))
                a = a[(lo[a] == hi[a]) | (second[a] != second[a + d])]
                for k in range(0, len(a), 1 << 16):
                    part = a[k:k + (1 << 16)]
                    hit = part[near(n, cells, part, part + d)]
                    left.append(hit)
                    right.append(hit + d)
            for b, m in zip(start[size > LEAF].tolist(), size[size > LEAF].tolist(), strict=True):
                found = connect(n[b:b + m], cells[b:b + m], second[b:b + m], lo[b] != hi[b])
                left.append(np.array([x for x, _ in found], np.int64) + b)
                right.append(np.array([y for _, y in found], np.int64) + b)
            a, b = np.concatenate(left), np.concatenate(right)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])
    return run


class _Sets:
    """Sets of a cluster's documents, with the links found so far as a forest."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, num: int, den: int):
        self.grams = np.unique(hashes, return_inverse=True)[1]
        self.sizes, self.num, self.den = sizes, num, den
        self.ends = np.cumsum(sizes)
        self.flag = np.zeros(int(self.grams.max(initial=-1)) + 1, bool)
        self.root = np.arange(len(sizes))
        self.edges: list[tuple[int, int]] = []

    def distances(self, p: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(Jaccard distance of document p to each of ``others``; whether they are linked)."""
        own = self.grams[self.ends[p] - self.sizes[p]:self.ends[p]]
        self.flag[own] = True
        sizes = self.sizes[others]
        at = np.concatenate([np.arange(self.ends[o] - self.sizes[o], self.ends[o]) for o in others.tolist()])
        both = np.add.reduceat(self.flag[self.grams[at]].astype(np.int64), np.cumsum(sizes) - sizes)
        self.flag[own] = False
        union = sizes + len(own) - both
        return 1 - both / union, self.den * both >= self.num * union

    def link(self, p: int, others: np.ndarray) -> None:
        for o in others.tolist():
            if self.root[o] != self.root[p]:
                self.root[self.root == self.root[o]] = self.root[p]
                self.edges.append((p, o))

    def compare(self, p: int, others: np.ndarray) -> np.ndarray:
        distance, linked = self.distances(p, others)
        self.link(p, others[linked])
        return distance

    def join(self, docs: np.ndarray, second: np.ndarray | None, depth: int = 0) -> None:
        """Finds components of ``docs``; with ``second``, only pairs across that flag count."""
        reach = 1 - self.num / self.den + 1e-9
        if len(docs) > LEAF and depth < 8:
            # pivots: each the farthest from those before
            pivots, nearest, table = [int(docs[0])], None, []
            for _ in range(PIVOTS):
                p = pivots[-1]
                table.append(self.distances(p, docs)[0])
                nearest = table[-1] if nearest is None else np.minimum(nearest, table[-1])
                far = int(np.argmax(nearest))
                if nearest[far] <= reach:
                    break
                pivots.append(int(docs[far]))
            d = np.stack(table)
            home = d.argmin(axis=0)
            windows = [(home == j) | (d[j] <= nearest + 2 * reach) for j in range(len(d))]
            if max(w.sum() for w in windows) < 0.9 * len(docs):
                for j, w in enumerate(windows):
                    if (home == j).any():
                        self.join(docs[w], second, depth + 1)
                return
        for k, p in enumerate(docs.tolist()):
            rest = docs[k + 1:]
            rest = rest[self.root[rest] != self.root[p]]
            if second is not None:
                rest = rest[second[rest] != second[p]]
            # sizes as distances to the empty set
            fit = self.num * np.maximum(self.sizes[rest], self.sizes[p]) <= self.den * np.minimum(
                self.sizes[rest], self.sizes[p])
            if fit.any():
                self.compare(p, rest[fit])


def _cluster_edges(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            cluster, lo, hi = (_numbers(table, x) for x in ("cluster", "lo", "hi"))
            start = np.flatnonzero(np.append(True, (cluster[1:] != cluster[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
            for b, e in zip(start.tolist(), [*start[1:].tolist(), len(cluster)], strict=True):
                part = table.slice(b, e - b)
                ids, second = _numbers(part, "_id"), _numbers(part, "second").astype(bool)
                chunks = text_chunks(part.select(["_id", "_text"]).to_batches(), CHUNK_CHARS)
                hashes, sizes = map(np.concatenate, zip(*(ngram_sets(t, width) for _, t in chunks), strict=True))
                held = np.flatnonzero(sizes > 0)
                sets = _Sets(hashes, sizes, num, den)
                sets.join(held[np.argsort(sizes[held], kind="stable")], second if lo[b] != hi[b] else None)
                if sets.edges:
                    x, y = np.array(sets.edges).T
                    yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], names=["a", "b"])
    return run


def join(df: DataFrame, width: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id_col``, n_shingles, class_id (smallest id with the same set),
    component_id (smallest id that links reach), row_key (:func:`~attrition.llm.suffix.text_key`), kept
    (whether the row is its component's first).  A link: ``den * |x & y| >= num * |x | y|``."""
    rows = id_and_text(df, id_col, text_col).select(
        F.struct(F.col("_id").alias("id"), text_key(F.col("_text")).alias("key")).alias("own"), "_text")
    tasks = shuffle_partitions(df.sparkSession)
    cut = min((3 * (den - num) << 64) // (2 * den), (1 << 64) - 1)
    # _id is the row's number from here on
    profile = stored(rows.mapInArrow(trimmed(_profiles(width, num, den, cut)), PROFILE).withColumn(
        "_id", F.monotonically_increasing_id()), "profiles")
    sets = profile.filter("n > 0")
    rank = F.struct(F.col("own.id").isNull().alias("none"), "own.id", "own.key")
    classes = stored(sets.groupBy("h1", "h2", "n").agg(
        F.min(F.struct("_id", "own.key")).alias("_one"), F.min(rank).alias("first")).select(
        "h1", "h2", "n", F.col("_one._id").alias("class"), F.col("_one.key").alias("key"), "first"), "classes")

    counted = sets.select("_id", F.explode("low").alias("s"))
    often = counted.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = counted.join(often, "s").groupBy("_id").agg(
        F.sort_array(F.collect_list(F.struct("c", "s"))).alias("shared"))
    window = F.expr(f"n - ceil({num}L * n / {den}) + 1")   # exact: the quotient is far below 2**53
    one_each = classes.select(F.col("class").alias("_id"))
    whole = sets.join(one_each, "_id", "left_semi").select("_id", "n", "n_low", "cells", "high")
    take = F.greatest(F.lit(0), window - F.col("n_low") + F.size("shared")).cast("int")
    placed = whole.join(shared, "_id", "left").withColumn("shared", F.coalesce("shared", F.array().cast(
        "array<struct<c:bigint,s:bigint>>")))
    regions = placed.select("_id", "n", "cells", F.explode(F.concat(
        F.transform(F.slice("shared", F.lit(1), take), lambda x: x["s"]), "high")).alias("s"))
    dealt = in_blocks(stored(regions, "regions"), "s", REGION_ROWS)
    near = (dealt.repartition(tasks, "s", "lo", "hi").sortWithinPartitions("s", "lo", "hi", "n")
            .select("s", "lo", "hi", "n", "_id", "second", "cells").mapInArrow(trimmed(_region_edges(num, den)), "a bigint, b bigint"))
    clusters = components(near).select(F.col("id").alias("_id"), F.col("component").alias("cluster"))

    wanted = clusters.join(classes.select(F.col("class").alias("_id"), "key"), "_id")
    members = rows.select(F.col("own.key").alias("key"), "_text").join(wanted, "key").select(
        "cluster", "_id", "_text", F.octet_length("_text").cast("long").alias("_bytes")).dropDuplicates(["cluster", "_id"])
    dealt = in_blocks(stored(members, "members"), "cluster", CLUSTER_ROWS, weight="_bytes", heaviest=CLUSTER_BYTES)
    links = (dealt.repartition(tasks, "cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
             .select("cluster", "lo", "hi", "_id", "second", "_text")
             .mapInArrow(trimmed(_cluster_edges(width, num, den)), "a bigint, b bigint"))
    linked = classes.join(components(links).select(F.col("id").alias("class"), "component"), "class", "left").select(
        "h1", "h2", "n", "first", F.coalesce("component", "class").alias("component"))
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    found = linked.join(heads, "component").select("h1", "h2", "n", "first", "head")
    own = F.col("own.id")
    return (profile.select("own", "n", "h1", "h2").join(found, ["h1", "h2", "n"], "left")
            .select(own.alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.when(own.isNotNull(), F.coalesce("first.id", "own.id")).alias("class_id"),
                    F.when(own.isNotNull(), F.coalesce("head.id", "own.id")).alias("component_id"),
                    F.col("own.key").alias("row_key"),
                    (F.col("head").isNull() | rank.eqNullSafe(F.col("head"))).alias("kept")))


def keep_one(df: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are the first of their component (rows equal in id and text stay together)."""
    drop = stored(joined.filter(~F.col("kept")).select(
        F.col(id_col).alias("__x_id"), F.col("row_key").alias("__x_key")).distinct(), "dropped")
    return df.join(drop, F.col(id_col).cast("long").eqNullSafe(F.col("__x_id"))
                   & (text_key(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__x_key")), "left_anti")
