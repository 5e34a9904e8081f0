"""Clustering in whole numbers against a plain loop over all centroids."""

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import clusters


def plain(rows, count, rounds, dimensions, seed=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) and abs(x) < 2**19 for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in first[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for c in range(len(points)):
            own = [v for (_, v), (_, n) in zip(kept, near) if n == c]
            if own:
                points[c] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    by = {c: sum(d for d, n in near if n == c) for c in range(len(points))}
    return sorted(((i, c, d, by[c], sum(by.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, near)), key=str)


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    made = sorted((tuple(r) for r in clusters.cluster_vectors(df, **settings).collect()), key=str)
    assert made == plain(rows, settings["count"], settings["rounds"], settings["dimensions"])
    return made


def test_random_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(8) / 3).astype(np.float32).tolist()) for i in range(300)]
    check(spark, rows, count=20, rounds=3, dimensions=8)


def test_ties_copies_and_odd_vectors(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(81)]  # every distance ties
    odd = [(None, [0.5, 0.5]), (None, [0.5, 0.5]), (100, None), (101, [1.0]), (102, [1.0, None]), (103, [1.0, math.nan]), (104, [math.inf, 0.0]), (105, []),
           (7, [-0.001, 2000.25]), (7, [-0.001, 2000.25]), (106, [1e30, 0.0]), (107, [524287.0, -524287.0]), (108, [1.0, 2.0, 3.0])]
    made = check(spark, grid + odd, count=12, rounds=4, dimensions=2)
    assert len(made) == 81 + 5
    check(spark, grid[:3], count=12, rounds=2, dimensions=2)
    check(spark, [(i, [1.0, 1.0]) for i in range(50)], count=5, rounds=2, dimensions=2)


def test_no_vectors_and_other_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 3, "x")], "vec_id long, embedding array<float>, cluster int, v string")
    assert clusters.cluster_vectors(df, dimensions=3).count() == 0
    assert clusters.cluster_vectors(df.where("false"), dimensions=2).count() == 0
    assert clusters.cluster_vectors(df, dimensions=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("spread", [0, 1, 40])
def test_tree_search_is_exact_and_prunes(spread):
    rng = np.random.default_rng(spread)
    points = rng.integers(-3, 4, (200, 4)) + 100 * rng.integers(-spread, spread + 1, (200, 1))
    rows = points[rng.integers(0, 200, 500)] + rng.integers(-2, 3, (500, 4))
    tree = clusters.build_tree(points)
    best, distance, computed = clusters.nearest_centroids(rows, points, tree)
    every = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert spread < 40 or computed < every.size / 3
    members = sorted(m for node in tree for m in [*node.members, node.point] if m >= 0)
    assert members == list(range(200))
