"""Vector searches against brute force, on odd vectors and on none."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.llm import graph, topk
from sensorlens.llm.registry import load
from sensorlens.llm.vectors import usable

QUERIES = load()[0]
ODD = [
    (0, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [2.0, 4.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]), (7, [0.0, 0.0]), (8, [5.0]), (9, []), (None, [9.0, 9.0]), (2, [2.0, 4.0]),
    (10, [-3.0, 1.0]), (0, [1.0, 2.0]), (11, [1e6, -1e6]),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash"))


def kept(zeros):
    rows = [(i, v) for i, v in ODD if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return [(i, np.array([*v, 0.0, 0.0][:2])) for i, v in rows if zeros or any(v)]


def whole(df):
    return df.select("vec_id", F.transform("v", lambda x: F.floor(x * 256)).alias("v"))


def test_topk_of_odd_vectors(odd):
    rows = whole(usable(odd))
    got = [tuple(r) for r in topk.top_k(rows, rows, 3).orderBy("query_id", "rank").collect()]
    want = []
    for q, v in sorted({i: v for i, v in kept(True)}.items()):
        scores = sorted((-int(np.floor(256 * v) @ np.floor(256 * w)), i) for i, w in kept(True) if i != q)
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scores[:3], 1)]
    assert got == want
    assert topk.top_k(rows.limit(0), rows.limit(0), 3).count() == 0


@pytest.mark.parametrize("scale", [1, 1_000_000])
def test_impact_index_is_exact(scale):
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(3000, 16)) * 90 * scale).astype(np.int64)
    rows[100:900] = rows[5]  # many copies, all tied
    ids = rng.permutation(3000)
    index = topk.ImpactIndex(ids, rows)
    for q in (5, 17, 100, 2500):
        exact = np.array([int(sum(int(a) * int(b) for a, b in zip(r, rows[q]))) for r in rows])
        order = np.lexsort((ids, -exact))
        order = order[ids[order] != ids[q]][:7]
        got = index.search(rows[q], ids[q], 7)
        assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == exact[order].tolist()


def test_neighbours_of_odd_vectors(odd):
    rows = usable(odd).filter(F.exists("v", lambda x: x != 0))
    got = [tuple(r) for r in graph.nearest(graph.build_graphs(rows), rows, 4).orderBy("query_id", "rank").collect()]
    want = []
    for q, v in sorted({i: v for i, v in kept(False)}.items()):
        away = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in kept(False) if i != q)
        want += [(q, k, i, d) for k, (d, i) in enumerate(away[:4], 1)]
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    none = graph.build_graphs(rows.limit(0))
    assert graph.nearest(none, rows.limit(0), 4).count() == 0


def test_recall_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, points = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in QUERIES["op10_graph_neighbours"](spark, sf_dir).collect():
        at = np.flatnonzero(ids == r["vec_id"])[0], np.flatnonzero(ids == r["query_id"])[0]
        assert abs(r["score"] - np.sqrt(((points[at[0]] - points[at[1]]) ** 2).sum())) < 1e-12
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(found) == sorted(i for i in ids if i % 100 == 0)
    hits = 0
    for q, got in found.items():
        away = ((points - points[ids == q]) ** 2).sum(axis=1)
        order = np.lexsort((ids, away))
        hits += len(got & set(ids[order[ids[order] != q][:10]]))
    assert hits >= 0.9 * 10 * len(found)


def test_copies_do_not_hide_neighbours():
    rng = np.random.default_rng(3)
    points = np.unique(rng.normal(size=(1500, 12)), axis=0)
    made = graph.Graph(points)
    found = graph.beam_search(points, made.nexts, made.entries, points[:200], 64)[0]
    assert (found[:, 0] == np.arange(200)).mean() > 0.98
    assert made.nexts.max() < len(points) and (made.nexts >= 0).sum(axis=1).min() >= 1


def hard_points(kind):
    """4 000 vectors that lie in tight clusters, or a third of which are near copies."""
    rng = np.random.default_rng(12)
    if kind == "clusters":
        return np.repeat(rng.normal(size=(40, 64)), 100, axis=0) + rng.normal(size=(4000, 64)) * 0.01
    if kind == "many clusters":
        return np.repeat(rng.normal(size=(160, 64)), 25, axis=0) + rng.normal(size=(4000, 64)) * 0.001
    points = rng.normal(size=(4000, 64))
    if kind == "near copies":
        points[:1333] = points[0] + rng.normal(size=(1333, 64)) * 0.001
    return points


@pytest.mark.parametrize("kind", ["clusters", "many clusters", "near copies", "gauss"])
@pytest.mark.parametrize("shards", [1, 4])
def test_recall_on_hard_vectors(spark, kind, shards):
    points = hard_points(kind)[np.random.default_rng(1).permutation(4000)]
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, v array<double>").repartition(3)
    graphs = graph.build_graphs(rows, shard_bytes=-(-points.size * 8 // shards))
    assert graphs.select("shard").distinct().count() == shards
    found = {}
    for r in graph.nearest(graphs, rows.filter("vec_id % 20 = 0"), 10).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, got in found.items():
        away = ((points - points[q]) ** 2).sum(axis=1)
        away[q] = np.inf
        hits += len(got & set(np.argsort(away, kind="stable")[:10].tolist()))
    assert len(found) == 200 and hits >= 0.9 * 2000, hits / 2000


@pytest.mark.parametrize("kind", ["clusters", "near copies"])
def test_every_point_can_be_reached(kind):
    made = graph.Graph(hard_points(kind))
    reached = np.zeros(4000, bool)
    made._reach(made.entries, reached)
    assert reached.all()
