"""Centroid clustering against plain k-means in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from sparkwell.llm import centroid_clustering
from sparkwell.llm.centroid_clustering import Centroids, Memory, assign

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, a string, limb string"


def by_hand(rows, k, rounds, scale, dims):
    """{row: (id, cluster, distance, cluster inertia, inertia, digest)}; starts as the operator's contract says."""
    sound = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    x = [[scale * int(c) if abs(c) > 1e300 else math.floor(scale * c) for c in v] for _, v in sound]
    order = sorted(range(len(x)), key=lambda r: (hashlib.sha256(f"1:{'' if sound[r][0] is None else sound[r][0]}".encode()).hexdigest(), sound[r][1]))
    centroids = [x[r] for r in order[:k]]
    far = lambda p, q: sum((a - b) ** 2 for a, b in zip(p, q, strict=True))
    for turn in range(rounds + 1):
        nearest = [min((far(p, c), j) for j, c in enumerate(centroids)) for p in x]
        if turn < rounds:
            groups = [[p for p, (_, j) in zip(x, nearest, strict=True) if j == g] for g in range(len(centroids))]
            centroids = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else old for g, old in zip(groups, centroids, strict=True)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own = [sum(d for d, j in nearest if j == g) for g in range(len(centroids))]
    return sorted(((i, j, d, own[j], sum(own), digest[j]) for (i, _), (d, j) in zip(sound, nearest, strict=True)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "d", "a", "l") for i, v in rows], SCHEMA).repartition(3)


def found(spark, rows, **how):
    return sorted((tuple(r) for r in centroid_clustering.cluster(frame(spark, rows), **how).collect()), key=repr)


def grouped(n=300, dims=8):
    chance = np.random.default_rng(4)
    centres = chance.standard_normal((9, dims))
    points = centres[chance.integers(0, 9, n)] + 0.2 * chance.standard_normal((n, dims))
    return [(i, p.tolist()) for i, p in enumerate(points)]


@pytest.mark.parametrize("k, rounds", [(16, 3), (5, 6), (1, 2), (2, 1), (7, 0)])
def test_same_clusters(spark, k, rounds):
    rows = grouped()
    assert found(spark, rows, k=k, rounds=rounds, scale=64, dims=8) == by_hand(rows, k, rounds, 64, 8)


def test_odd_vectors_ties_and_repeats(spark):
    rows = grouped(60, 4)
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (None, [1.0, -1.0, 0.25, 0.0]), (7, [0.0] * 4), (7, [0.0] * 4), (7, [-0.0] * 4)]
    rows += [(100 + i, [float(i % 3), 0.0, 0.0, 0.0]) for i in range(30)]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None, 0.0, 0.0]), (204, [math.nan] * 4), (205, [math.inf, 0.0, 0.0, 0.0])]
    assert found(spark, rows, k=16, rounds=3, dims=4) == by_hand(rows, 16, 3, 64, 4)


def test_equal_starts_leave_clusters_empty(spark):
    rows = [(i, [1.0, 2.0]) for i in range(20)] + [(50, [9.0, 9.0])]
    assert found(spark, rows, k=8, rounds=3, dims=2) == by_hand(rows, 8, 3, 64, 2)


def test_large_components_stay_exact(spark):
    """Sums beyond 64 bits, and integers that no double holds; what doesn't fit in a long is null."""
    rows = [(i, [float(2**40 + 3 * i), -float(2**41) * (i % 2)]) for i in range(12)] + [(90, [1.5e308, -1.7e308]), (91, [1e25, 3.0])]
    fits = lambda v: v if v < 2**63 else None
    wanted = []
    hand = by_hand(rows, 3, 3, 64, 2)
    for i, j, d, own, whole, digest in hand:
        wide = any(fits(e) is None for _, g, e, *_ in hand if g == j)
        wanted.append((i, j, fits(d), None if wide else fits(own), fits(whole), digest))
    assert found(spark, rows, k=3, rounds=3, dims=2) == sorted(wanted, key=repr)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = grouped(5, 3)
    assert found(spark, rows, k=16, rounds=3, dims=3) == by_hand(rows, 16, 3, 64, 3)
    assert found(spark, [], k=16, dims=3) == found(spark, [(1, None)], k=16, dims=3) == []


def test_bounds_save_distances(monkeypatch):
    """After a small move most vectors are settled by their bounds, and the answer is that of a full search."""
    chance = np.random.default_rng(5)
    centres = chance.integers(-2000, 2000, (32, 6))
    x = centres[chance.integers(0, 32, 4000)] + chance.integers(-60, 60, (4000, 6))
    first = Centroids.first(centres.tolist())
    known = assign(x, first, Memory.none(len(x)))
    moved = first.after({c: (1, (centres[c] + 3).tolist()) for c in range(32)})
    counted = []
    plain = centroid_clustering.squared
    monkeypatch.setattr(centroid_clustering, "squared", lambda a, b: counted.append(len(a)) or plain(a, b))
    again = assign(x, moved, known)
    full = plain(x[:, None], moved.points[None])
    assert again.first.tolist() == full.argmin(axis=1).tolist()
    assert sum(counted) < 0.2 * len(x)
    ranked = np.sort(np.sqrt(full), axis=1)
    assert (again.upper >= ranked[:, 0] * (1 - 1e-9)).all() and (again.lower <= ranked[:, 1] * (1 + 1e-9)).all()
