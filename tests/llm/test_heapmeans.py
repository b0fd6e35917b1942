"""Heap-ordered clustering against plain rounds that measure every vector."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.llm import heapmeans
from sensorlens.llm.heapmeans import Centroids, cluster, whole_vectors, with_inertia


def plain(rows, k, rounds, seed=1):
    """(vec_id, cluster, distance) with Python integers alone."""
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    named = sorted((digest(i) if i is not None else "~", v) for i, v in rows)
    centroids = [list(v) for _, v in named[:k]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for turn in range(rounds + 1):
        at = [min(range(len(centroids)), key=lambda j: (away(v, centroids[j]), j)) for _, v in rows]
        if turn == rounds:
            return [(i, j, away(v, centroids[j])) for (i, v), j in zip(rows, at)], centroids
        for j in range(len(centroids)):
            own = [v for (_, v), a in zip(rows, at) if a == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, v array<int>")


def kinds():
    rng = np.random.default_rng(2)
    tight = np.repeat(rng.integers(-900, 900, (12, 8)), 40, axis=0) + rng.integers(-3, 4, (480, 8))
    copies = np.repeat(rng.integers(-50, 50, (5, 8)), 60, axis=0)
    grid = rng.integers(-2, 3, (400, 8))  # many equal distances
    return {"tight": tight, "copies": copies, "grid": grid, "huge": rng.integers(-(2**27), 2**27, (60, 8))}


@pytest.mark.parametrize("kind", ["tight", "copies", "grid", "huge"])
def test_same_clusters_as_plain_rounds(spark, kind):
    rows = [(i, v) for i, v in enumerate(kinds()[kind].tolist())]
    found = cluster(frame(spark, rows).repartition(5), k=10, rounds=6)
    want, centroids = plain(rows, 10, 6)
    assert sorted(map(tuple, found.rows.collect())) == sorted(want)
    assert found.centroids == centroids


def test_only_expired_gaps_are_measured(monkeypatch):
    points = kinds()["tight"]
    now = Centroids(points[::40].copy(), np.zeros(12))
    at, _, raised = now.rescan(points)
    later = now.moved(now.at + 1)
    popped = heapmeans.expired(at, raised, later.drift)
    assert len(popped) < len(points) / 4
    exact = later.rescan(points)[0]
    stay = np.setdiff1d(np.arange(len(points)), popped)
    assert (exact[stay] == at[stay]).all()


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (5, [1.0]),
        (6, [1.0, 2.0, 3.0]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (None, [5.0, 5.0]), (8, [-0.01, 0.01]), (9, [1e300, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("v", "cluster", "distance", "raised", "was")])
    whole = whole_vectors(clash, 64, 2)
    kept = [(r["vec_id"], list(r["v"])) for r in whole.collect()]
    assert sorted(kept, key=repr) == sorted([(0, [64, 128]), (7, [0, 0]), (7, [0, 0]), (None, [320, 320]), (8, [-1, 0])], key=repr)
    got = with_inertia(cluster(whole, 16, 3)).collect()
    want, centroids = plain(kept, 16, 3)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["inertia"] == sum(w[2] for w in want)
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_no_vectors(spark):
    none = whole_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), 64, 64)
    assert with_inertia(cluster(none, 16, 3)).count() == 0
    one = with_inertia(cluster(frame(spark, [(4, [1, 2])]), 16, 3)).collect()
    assert [(r["vec_id"], r["cluster"], r["distance"], r["inertia"]) for r in one] == [(4, 0, 0, 0)]
