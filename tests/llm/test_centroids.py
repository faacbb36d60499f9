from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from martloom.llm import centroids


def distance(p, q):
    return sum((a - b) ** 2 for a, b in zip(p, q, strict=True))


def brute(rows, dimensions, k, rounds, seed):
    points = [
        (i, [math.floor(1024 * x) if abs(x) < 2**40 else int(x) * 1024 for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(points, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", ",".join(map(str, r[1]))))
    at = [v for _, v in order[:k]]
    for turn in range(rounds + 1):
        near = [min((distance(v, c), j) for j, c in enumerate(at)) for _, v in points]
        if turn < rounds:
            for j in range(len(at)):
                mine = [v for (_, v), (_, a) in zip(points, near, strict=True) if a == j]
                if mine:
                    at[j] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    return sorted([(i, a, d if d < 1 << 63 else None) for (i, _), (d, a) in zip(points, near, strict=True)], key=repr), at


@pytest.fixture
def vectors(spark):
    def build(rows, kind="float"):
        return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id bigint, embedding array<{kind}>, cluster int, state string")

    return build


def random_rows(n, dimensions, seed, groups=5):
    rng = random.Random(seed)
    middles = [[rng.uniform(-2, 2) for _ in range(dimensions)] for _ in range(groups)]
    return [(i, [float(np.float32(m + rng.gauss(0, 0.3))) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("k, rounds", [(8, 10), (1, 2), (3, 0), (40, 4)])
def test_clusters_equal_brute_force(vectors, monkeypatch, k, rounds):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 50)
    rows = random_rows(400, 6, 1)
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # copies: ties between centroids
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0] * 7), (2004, [None] + [1.0] * 5), (2005, [math.nan] * 6)]
    rows += [(2006, [math.inf] * 6), (2007, [0.0] * 6), (2008, [-0.0009] * 6), (None, [0.5] * 6), (5, [0.25] * 6)]
    found = centroids.cluster(vectors(rows), 6, k, rounds, 3)
    want, at = brute(rows, 6, k, rounds, 3)
    assert sorted([tuple(r) for r in found.vectors.collect()], key=repr) == want
    assert found.centroids == at


def test_grid_points_tie_often(vectors):
    rows = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(160)]
    found = centroids.cluster(vectors(rows), 2, 7, 6, 3)
    want, at = brute(rows, 2, 7, 6, 3)
    assert sorted([tuple(r) for r in found.vectors.collect()], key=repr) == want and found.centroids == at


def test_large_components_stay_exact(vectors):
    rows = random_rows(30, 3, 2) + [(100 + i, [2.0**60 * (i + 1), -(2.0**60), 1.5]) for i in range(5)] + [(200, [2.0**18, 0.0, 0.0])]
    found = centroids.cluster(vectors(rows, "double"), 3, 4, 3, 3)
    want, at = brute(rows, 3, 4, 3, 3)
    assert sorted([tuple(r) for r in found.vectors.collect()], key=repr) == want and found.centroids == at


def test_fewer_vectors_than_centroids_and_none(vectors):
    rows = random_rows(3, 4, 4)
    assert len(centroids.cluster(vectors(rows), 4, 8, 2, 3).centroids) == 3
    for empty in (vectors(rows).limit(0), vectors([(1, None), (2, [1.0])])):
        digest = centroids.digest_columns(centroids.cluster(empty, 4, 8, 2, 3))
        assert digest.count() == 0
        assert digest.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_and_balls_save_distances():
    rng = np.random.default_rng(5)
    k, n, dimensions = 32, 3000, 8
    middles = rng.normal(0, 3000, (k, dimensions))
    points = np.floor(middles[rng.integers(0, k, n)] + rng.normal(0, 100, (n, dimensions))).astype(np.int64)
    at = [[int(v) for v in p] for p in points[:k]]
    first, second = np.zeros(n, np.int32), np.ones(n, np.int32)
    upper, lower = np.full(n, np.inf), np.zeros(n)
    before, work = None, []
    for _ in range(8):
        work.append(centroids.search(points, first, second, upper, lower, centroids.Centroids.of(at, before)))
        exact = [min((distance(map(int, p), c), j) for j, c in enumerate(at))[1] for p in points[:200]]
        assert first[:200].tolist() == exact
        before = at
        at = [[int(v) for v in points[first == j].sum(axis=0) // max((first == j).sum(), 1)] if (first == j).any() else at[j] for j in range(k)]
    assert work[0] < 0.8 * n * k and work[-1] < 0.1 * n * k


def test_blocks_meet_their_states_without_a_shuffle(vectors, spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 50)
    plans = []
    plain = centroids.map_batches

    def spy(df, function, schema):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, function, schema)

    monkeypatch.setattr(centroids, "map_batches", spy)
    centroids.cluster(vectors(random_rows(1000, 4, 6)), 4, 4, 2, 3)
    joined = [p for p in plans if "Join" in p]
    assert len(joined) == 3 and all("SortMergeJoin" in p and "Exchange" not in p for p in joined)
