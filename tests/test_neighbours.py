"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sensorlens.operators import model, neighbours

RNG = np.random.default_rng(11)


def clouds():
    """Tight clouds, single rows between them, and a point that a third of the rows share."""
    tight = np.repeat(RNG.normal(size=(20, 3)) * 50, 60, axis=0) + RNG.normal(size=(1200, 3)) * 0.01
    lone = RNG.uniform(-120, 120, size=(300, 3))
    return np.concatenate([tight, lone, np.tile([[7.0, -7.0, 0.0]], (750, 1))])


def frame_of(spark, points, first=0):
    rows = [(first + i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


def brute(queries, rows, k):
    out = []
    for q, p in enumerate(queries):
        d = p - rows
        away = np.sqrt(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2])
        order = np.lexsort((np.arange(len(rows)), away))[:k]
        out += [(q, i, int(j), float(away[j])) for i, j in enumerate(order, 1)]
    return out


@pytest.mark.parametrize("k", [1, 3, 11])
def test_same_neighbours_as_brute_force(spark, k, monkeypatch):
    rows = clouds()
    asking = np.concatenate([rows[::40] + RNG.normal(size=rows[::40].shape), rows[::70], [[1e6, 0, 0]], [[7.0, -7.0, 0.0]] * 2])
    monkeypatch.setattr(neighbours, "MOST_PIVOTS", 24)
    index = neighbours.build_index(frame_of(spark, rows).repartition(5), ["a", "b", "c"], k, ["id"], rows_per_cell=60, rows_per_ring=20)
    assert index.rings.count() > 2 * 24 and len(index.pivots) == 24
    found = neighbours.nearest(index, frame_of(spark, asking))
    at = frame_of(spark, asking).select("id", *[F.col(c).alias(f"_f{i}") for i, c in enumerate("abc")])
    got = at.withColumnRenamed("id", "q").join(found, ["_f0", "_f1", "_f2"]).select("q", "_rank", "id", "_distance")
    assert sorted(map(tuple, got.collect())) == brute(asking, rows, k)


def test_a_shared_point_is_kept_k_times(spark):
    rows = clouds()
    index = neighbours.build_index(frame_of(spark, rows), ["a", "b", "c"], 4, ["id"])
    assert index.points.filter("_f0 = 7 and _f1 = -7 and _f2 = 0").count() == 4
    assert index.points.count() == len(rows) - 750 + 4


def test_only_near_rings_are_read(spark):
    rows = clouds()[:1200]
    index = neighbours.build_index(frame_of(spark, rows), ["a", "b", "c"], 3, ["id"], rows_per_cell=60, rows_per_ring=20)
    plan = neighbours.nearest(index, frame_of(spark, rows[::10]))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
    met = []
    whole = neighbours._met
    neighbours._met = lambda *a: met.append(whole(*a)) or met[-1]
    try:
        neighbours.nearest(index, frame_of(spark, rows[::10]))
    finally:
        neighbours._met = whole
    assert sum(df.count() for df in met) < 120 * len(rows) / 4


def test_a_query_meets_few_rows_of_an_even_cloud(spark, monkeypatch):
    rows, met, whole = RNG.uniform(0, 100, size=(12_000, 3)), [], neighbours._met
    index = neighbours.build_index(frame_of(spark, rows), ["a", "b", "c"], 3, ["id"])
    monkeypatch.setattr(neighbours, "_met", lambda *a: met.append(whole(*a)) or met[-1])
    neighbours.nearest(index, frame_of(spark, rows[::40]))
    assert sum(df.count() for df in met) < 1_000 * 300


def test_missing_values_small_tables_and_ties(spark, frame):
    rows = frame("id long, a double, b double", (1, 0.0, 0.0), (2, 0.0, 2.0), (3, 2.0, 0.0), (4, None, 0.0), (5, float("nan"), 1.0),
                 (6, float("inf"), 1.0), (2, 0.0, 2.0))
    asking = frame("id long, a double, b double", (10, 1.0, 1.0), (11, None, 1.0), (12, -0.0, 0.0))
    got = sorted(map(tuple, neighbours.nearest_rows(asking, rows, ["a", "b"], 9).select("query_id", "rank", "id").collect()))
    assert got == [(10, 1, 1), (10, 2, 2), (10, 3, 2), (10, 4, 3), (12, 1, 1), (12, 2, 2), (12, 3, 2), (12, 4, 3)]
    assert neighbours.nearest_rows(asking, rows.limit(0), ["a", "b"], 3).count() == 0
    assert neighbours.nearest_rows(asking.limit(0), rows, ["a", "b"], 3).count() == 0
    with pytest.raises(ValueError):
        neighbours.build_index(rows, ["a"], 0, ["id"])


def vectors(spark, rows):
    return spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in rows], ["features", "label"])


@pytest.mark.parametrize("weights, classes, values", [("uniform", [0.0] * 3, [1 / 3] * 3), ("distance", [0.0, 1.0, 1.0], [0.0, 1.0, None])])
def test_votes(spark, weights, classes, values):
    train = vectors(spark, [([0.0], 0), ([1.0], 1), ([3.0], 0), ([-50.0], 1), ([-51.0], 1)])
    asking = vectors(spark, [([0.0], 9), ([1.0], 9), ([1.25], 9)]).coalesce(1)
    for registry, name, want in ((model.CLASSIFIERS, "knn_classifier", classes), (model.REGRESSORS, "knn_regressor", values)):
        made = model.build_estimators({name: {"n_neighbors": 3, "weights": weights}}, registry)[name]
        scored = {r["features"][0]: r["prediction"] for r in made.fit(train).transform(asking).collect()}
        got = [scored[x] for x in (0.0, 1.0, 1.25)]
        for g, w in zip(got, want):
            if w is None:
                a, b, c = 1 / 1.25, 1 / 0.25, 1 / 1.75
                w = b / (a + b + c)
            assert g == pytest.approx(w)


def test_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        model.build_estimators({"knn_classifier": {"weights": "other"}})
    with pytest.raises(ValueError):
        model.build_estimators({"knn_classifier": {"metric": "cosine"}})
    with pytest.raises(ValueError):
        neighbours.NeighbourClassifier(weights="far")
