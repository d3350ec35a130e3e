"""Shallot search against every distance worked out, and whole rounds against plain k-means."""

import hashlib
import math

import numpy as np
import pytest

from attrition.llm import shallot


@pytest.mark.parametrize("seed", range(12))
def test_rounds_equal_full_search(seed):
    rng = np.random.default_rng(seed)
    k, dims, n = int(rng.integers(1, 30)), int(rng.integers(1, 8)), 400
    x = rng.integers(-40, 40, (n, dims))
    x[:120] = x[0]                              # a vector with a third of the rows, ties among centroids
    centroids, moved = x[rng.choice(n, k)].copy(), None
    near, bounds, searched = np.tile([0, 1], (n, 1)), np.tile([np.inf, 0.0], (n, 1)), []
    for _ in range(8):
        near, bounds, looked = shallot.assign(x, near, bounds, shallot.Centres(centroids, moved))
        searched.append(looked)
        full = np.stack([shallot.squared(x, c) for c in centroids], 1)
        own = full.argmin(axis=1)
        assert (near[:, 0] == own).all()
        nearest = np.sqrt(np.sort(full, axis=1).astype(float))
        assert (bounds[:, 0] >= nearest[:, 0] - 1e-6).all()
        if k > 1:
            assert (bounds[:, 1] <= nearest[:, 1] + 1e-6).all()
        new = np.array([x[own == i].sum(axis=0) // (own == i).sum() if (own == i).any() else c for i, c in enumerate(centroids)])
        moved, centroids = np.sqrt(shallot.squared(new, centroids).astype(float)), new
    assert k == 1 or searched[-1] < n           # bounds leave vectors out


def _plain(vectors: list[tuple], k: int, rounds: int) -> dict:
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"s:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in first[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        groups = [[v for (_, v), o in zip(kept, own, strict=True) if o == c] for c in range(len(points))]
        points = [[sum(col) // len(g) for col in zip(*g, strict=True)] if g else p for g, p in zip(groups, points, strict=True)]
    rows = sorted(((i is not None, i or 0), near(v)[1], near(v)[0]) for i, v in kept)
    inertia = {c: sum(d for _, o, d in rows if o == c) for c in range(len(points))}
    return {"rows": rows, "points": points, "inertia": inertia}


def test_tables_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(0, 2, (150, 6)).round(3).tolist()
    data += [data[0]] * 70
    good = [(k, v) for k, v in enumerate(data)] + [(3, data[9]), (None, data[4]), (None, data[5])]
    bad = [(900, None), (901, data[0][:5]), (902, [*data[0], 1.0]), (903, [math.nan, *data[0][1:]]),
           (904, [math.inf, *data[0][1:]]), (905, [None, *data[0][1:]]), (906, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id bigint, embedding array<double>, cluster int").repartition(3)
    want = _plain(good, 12, 3)
    rows, table = shallot.cluster(df, 12, 3, 6, salt="s:")
    assert rows.columns == ["vec_id", "cluster", "distance"]
    assert sorted(((r.vec_id is not None, r.vec_id or 0), r.cluster, r.distance) for r in rows.collect()) == want["rows"]
    summary = {r.cluster: r for r in table.collect()}
    assert [summary[c].centroid for c in range(12)] == want["points"]
    assert {c: int(r.inertia) for c, r in summary.items()} == want["inertia"]


def test_few_vectors_none_and_too_large_ones(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(1, [0.5, -0.5]), (2, [3.0, 1.0])], schema)
    rows, table = shallot.cluster(few, 40, 2, 2)
    assert sorted(r.distance for r in rows.collect()) == [0, 0] and table.count() == 2
    one, _ = shallot.cluster(few, 1, 2, 2)
    assert [r.cluster for r in one.collect()] == [0, 0]
    rows, table = shallot.cluster(few.limit(0), 40, 2, 2)
    assert rows.count() == 0 and table.count() == 0
    with pytest.raises(Exception, match="would not be exact"):
        shallot.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), 2, 1, 2)
