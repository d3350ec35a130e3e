"""Exact k-means on integer vectors with Shallot search.

Vectors become whole numbers, ``floor(scale * x)``, and lie in blocks of a written table.  With each vector go its
nearest centroid, the one that was second nearest when it was last looked at, an upper bound on the
distance to the first and a lower bound on the distance to every other one.

A round first moves the bounds by what the centroids moved.  Vectors whose upper bound stays below
the lower one, or below half the way to the next centroid, keep theirs unseen.  The rest
start from the closer of their two remembered centroids and scan its neighbours in ascending order
of distance.  Nothing outside the ball of radius (distance to the start + distance to the second
best so far) can matter, and the ball shrinks with every better find.  Bounds only
rule out; what survives is compared in whole numbers, ties go to the smaller number.

Sums and counts of each block are added up by Spark, and the centroids (k times the dimensions, a fixed size) are
updated on the driver.  Each round's blocks are written, so a lost executor costs a re-read, and the
round before is deleted then.

Kept are vectors with exactly ``dims`` components, none null or non-finite; a component too large for exact squared
distances in 64 bits ends the job with an error.  Null ids hash as the empty text, repeated ids are vectors of their own (where
they are among the first centroids, by their components); with fewer than ``k`` vectors each is a centroid; an
empty table gives no rows.  Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm.common import discard, trimmed, written

BLOCK = 4096
SLACK = 1e-9        # bounds are floats: they rule out only with this relative margin
BLOCKS = "ids array<bigint>, vectors binary, near binary, bounds binary, distances binary, totals binary"
ARROW = pa.schema([("ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("vectors", "near", "bounds", "distances", "totals"))])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


@dataclass
class Centres:
    """Centroids, the distances among them, and how far each came since the round before."""

    points: np.ndarray
    moved: np.ndarray | None = None
    gaps: np.ndarray = field(init=False)
    neighbours: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        k = len(self.points)
        self.gaps = np.sqrt(np.array([squared(self.points, p) for p in self.points], np.float64).reshape(k, k))
        order = self.gaps + np.diag(np.full(k, -1.0))     # itself first, then by distance
        self.neighbours = np.argsort(order, axis=1, kind="stable")[:, 1:]
        moved = np.zeros(k) if self.moved is None else self.moved
        top = np.sort(moved)[-2:]
        #: the farthest that any other centroid came
        self.other_moved = np.where(moved == top[-1], top[0], top[-1]) if k > 1 else np.zeros(k)
        if k > 1 and (moved == top[-1]).sum() > 1:
            self.other_moved[:] = top[-1]
        self.half = self.gaps[np.arange(k), self.neighbours[:, 0]] / 2 if k > 1 else np.full(k, np.inf)


def search(x: np.ndarray, near: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray]:
    """(nearest and second-nearest centroid, their squared distances) of each row, from the two remembered ones."""
    c = centres.points
    rows = np.arange(len(x))
    near = near.astype(np.int64)
    dist = np.stack([squared(x, c[near[:, 0]]), squared(x, c[near[:, 1]])], 1)
    swap = (dist[:, 1] < dist[:, 0]) | ((dist[:, 1] == dist[:, 0]) & (near[:, 1] < near[:, 0]))
    near[swap], dist[swap] = near[swap, ::-1], dist[swap, ::-1]
    start, other, to_start = near[:, 0].copy(), near[:, 1].copy(), np.sqrt(dist[:, 0].astype(np.float64))
    live = rows
    for rank in range(len(c) - 1):
        j = centres.neighbours[start[live], rank]
        ball = (to_start[live] + np.sqrt(dist[live, 1].astype(np.float64))) * (1 + SLACK)
        inside = centres.gaps[start[live], j] <= ball
        live, j = live[inside], j[inside]
        if not len(live):
            break
        new = j != other[live]
        at, j = live[new], j[new]
        d = squared(x[at], c[j])
        first = (d < dist[at, 0]) | ((d == dist[at, 0]) & (j < near[at, 0]))
        second = ~first & ((d < dist[at, 1]) | ((d == dist[at, 1]) & (j < near[at, 1])))
        hit = at[first]
        near[hit, 1], dist[hit, 1] = near[hit, 0], dist[hit, 0]
        near[hit, 0], dist[hit, 0] = j[first], d[first]
        hit = at[second]
        near[hit, 1], dist[hit, 1] = j[second], d[second]
    return near, dist


def assign(x: np.ndarray, near: np.ndarray, bounds: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray, int]:
    """(near, bounds, vectors searched) after a round's assignment; ``near`` and ``bounds`` come from the round before."""
    near, bounds = near.copy(), bounds.copy()
    if len(centres.points) == 1:
        return np.zeros_like(near), np.tile([0.0, np.inf], (len(x), 1)), 0
    own = near[:, 0]
    if centres.moved is not None:
        bounds[:, 0] += centres.moved[own]
        bounds[:, 1] -= centres.other_moved[own]

    def unsure(of: np.ndarray) -> np.ndarray:
        limit = np.maximum(bounds[of, 1], centres.half[own[of]])
        return of[bounds[of, 0] * (1 + SLACK) + SLACK >= limit * (1 - SLACK)]

    left = unsure(np.arange(len(x)))
    bounds[left, 0] = np.sqrt(squared(x[left], centres.points[own[left]]).astype(np.float64))
    left = unsure(left)
    if len(left):
        near[left], dist = search(x[left], near[left], centres)
        bounds[left] = np.sqrt(dist.astype(np.float64))
    return near, bounds, len(left)


def _blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4")
                n = part.num_rows
                near = np.tile(np.array([0, 1], "<i4"), (n, 1))
                bounds = np.tile(np.array([np.inf, 0.0]), (n, 1))
                yield pa.RecordBatch.from_pylist([{
                    "ids": part.column(0).to_pylist(), "vectors": x.tobytes(), "near": near.tobytes(),
                    "bounds": bounds.tobytes(), "distances": None, "totals": None}], ARROW)
    return run


def _round(centres: Centres, last: bool):
    """A round's assignment; ``totals``: count, sums of components and of distances (last round) by centroid."""
    k, dims = centres.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["vectors"], "<i4").reshape(-1, dims).astype(np.int64)
                near = np.frombuffer(row["near"], "<i4").reshape(-1, 2)
                bounds = np.frombuffer(row["bounds"], "<f8").reshape(-1, 2)
                near, bounds, _ = assign(x, near, bounds, centres)
                own = near[:, 0]
                totals = np.zeros((k, dims + 2), np.int64)
                totals[:, 0] = np.bincount(own, minlength=k)
                if last:
                    distances = squared(x, centres.points[own])
                    np.add.at(totals[:, -1], own, distances)
                    row["distances"] = distances.astype("<i8").tobytes()
                else:
                    order = np.argsort(own, kind="stable")
                    held = np.flatnonzero(totals[:, 0])
                    totals[held, 1:-1] = np.add.reduceat(x[order], (np.cumsum(totals[:, 0]) - totals[:, 0])[held])
                row |= {"near": near.astype("<i4").tobytes(), "bounds": bounds.astype("<f8").tobytes(),
                        "totals": totals.astype("<i8").tobytes()}
                yield pa.RecordBatch.from_pylist([row], ARROW)
    return run


def _sum_totals(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * width for _ in range(k)]
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                part = np.frombuffer(blob, "<i8").reshape(k, width).tolist()
                total = [[a + b for a, b in zip(s, t, strict=True)] for s, t in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k * width), pa.int32()), pa.array([str(v) for row in total for v in row])], names=["cell", "total"])
    return run


def _totals(blocks: DataFrame, k: int, dims: int) -> list[list[int]]:
    """Count, sums of components and sum of distances of each centroid: k * (dims + 2) numbers, whatever the input."""
    width = dims + 2
    cells = blocks.select("totals").mapInArrow(_sum_totals(k, width), "cell int, total string").groupBy("cell").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()
    flat = [0] * (k * width)
    for r in cells:
        flat[r["cell"]] = int(r["total"])
    return [flat[i * width:(i + 1) * width] for i in range(k)]


def whole_vectors(df: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """_id and _vector (whole numbers) of the vectors that are kept."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    limit = math.isqrt((2**63 - 1) // dims) // 2
    limit = min(limit, 2**31) - 1
    scaled = F.transform(x, lambda v: F.lit(float(scale)) * v.cast("double"))
    checked = F.transform(scaled, lambda v: F.when(F.abs(v) < F.lit(float(limit)), F.floor(v)).otherwise(
        F.raise_error(F.lit(f"a scaled component is {limit} or more: squared distances would not be exact")).cast("bigint")))
    return df.filter((F.size(x) == dims) & fine).select(
        F.col(id_col).cast("long").alias("_id"), checked.cast("array<bigint>").alias("_vector"))


def cluster(df: DataFrame, k: int, rounds: int, dims: int, scale: int = 256, salt: str = "", id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(one row per kept vector: ``id_col``, cluster, distance (squared); one row per centroid: cluster, size, inertia,
    centroid).  The first centroids are the ``k`` vectors with the smallest hexadecimal SHA-256 of ``salt`` and the id.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, dims, scale, id_col, vector_col)
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    points = np.array([r["_vector"] for r in vectors.orderBy(key, "_vector").limit(k).collect()], np.int64).reshape(-1, dims)
    k = len(points)
    rows = f"{id_col} bigint, cluster int, distance bigint"
    table = "cluster int, size bigint, inertia decimal(38,0), centroid array<bigint>"
    if not k:
        return spark.createDataFrame([], rows), spark.createDataFrame([], table)
    blocks, path = written(vectors.mapInArrow(trimmed(_blocks(dims)), BLOCKS), "vectors")
    moved = None
    for number in range(rounds + 1):
        last = number == rounds
        centres = Centres(points, moved)
        found, new_path = written(blocks.mapInArrow(trimmed(_round(centres, last)), BLOCKS), "assigned")
        discard(spark, path)
        blocks, path = found, new_path
        totals = _totals(blocks, k, dims)
        if not last:
            new = np.array([[s // t[0] for s in t[1:-1]] if t[0] else p for t, p in zip(totals, points.tolist(), strict=True)],
                           np.int64)
            moved = np.sqrt(squared(new, points).astype(np.float64))
            points = new
    columns = F.arrays_zip(F.col("ids"), F.col("cluster"), F.col("distance"))
    assigned = blocks.mapInArrow(trimmed(_rows), "ids array<bigint>, cluster array<int>, distance array<bigint>").select(
        F.explode(columns).alias("v")).select(
        F.col("v.ids").alias(id_col), F.col("v.cluster").alias("cluster"), F.col("v.distance").alias("distance"))
    summary = [(i, t[0], Decimal(t[-1]), p) for i, (t, p) in enumerate(zip(totals, points.tolist(), strict=True))]
    return assigned, spark.createDataFrame(summary, table)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, near, distances in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                          for c in ("ids", "near", "distances")), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())),
                 pa.array([np.frombuffer(near, "<i4").reshape(-1, 2)[:, 0].tolist()], pa.list_(pa.int32())),
                 pa.array([np.frombuffer(distances, "<i8").tolist()], pa.list_(pa.int64()))],
                names=["ids", "cluster", "distance"])
