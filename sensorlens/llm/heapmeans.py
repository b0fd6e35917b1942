"""Centroid clustering with heap-ordered bounds, in whole numbers.

A vector's gap is a lower bound on the distance to any other centroid less an upper bound on the
distance to its own. When centroids move, the gap shrinks by at most the drift of its own centroid
plus the largest drift among the others, the same for all vectors of a cluster. So each cluster
keeps a heap of gaps, each raised by the drift that the cluster had accumulated when the gap was
measured: a round pops the entries that the accumulated drift has reached, measures exactly those
against all centroids, and leaves the others where they are without looking at their vectors.

Blocks of rows carry the heaps of their own vectors; rows never leave their partition. Each round
writes the rows with cluster and raised gap down and drops the table of the round before, so a
lost executor costs one round. Only vectors that changed their cluster enter the sums, which are
added up per cluster and component before they reach the driver: a table of as many centroids.

Nulls and repeats: vectors that are null, hold a null or non-finite component, have another number
of components or a whole component beyond 2**27 (whose squared distances overrun a long) take no
part; rows that share an id are vectors of their own; a null id takes part but is chosen last as a
first centroid. Equal distances go to the smaller centroid number. With fewer vectors than
centroids every vector starts one. Empty in, empty out. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, column, lists
from sensorlens.llm.tables import release, written
from sensorlens.llm.vectors import matrix

LARGEST = 1 << 27
EXACT_IN_DOUBLES = 1 << 21  # components up to this size give exact products in double precision
SLACK = 1e-6  # far above the rounding of a few square roots, far below any real gap
STATE = "vec_id long, v array<int>, cluster int, was int, raised double"


def whole_vectors(vectors: DataFrame, scale: int, width: int, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the usable vectors, each component x as floor(scale * x)."""
    fits = F.forall(
        vector,
        lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) <= F.lit(float(LARGEST))),
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    chosen = F.col(vector).isNotNull() & (F.size(vector) == width) & fits
    return vectors.filter(chosen).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest digests with the seed."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in first], np.int64)


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to all centroids."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if largest <= EXACT_IN_DOUBLES:
        a, b = points.astype(np.float64), centroids.astype(np.float64)
        apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
        return apart.astype(np.int64)
    out = np.empty((len(points), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        apart = points - c
        out[:, j] = (apart * apart).sum(axis=1)
    return out


@dataclass(frozen=True)
class Centroids:
    """The centroids of a round and the drift each cluster has accumulated until then."""

    at: np.ndarray
    drift: np.ndarray

    def moved(self, to: np.ndarray) -> Centroids:
        step = np.sqrt(((to - self.at).astype(np.float64) ** 2).sum(axis=1))
        others = np.array([max((s for j, s in enumerate(step) if j != i), default=0.0) for i in range(len(step))])
        return Centroids(to, self.drift + step + others)

    def rescan(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid, its squared distance, and the gap raised by the cluster's drift."""
        apart = squared_distances(points, self.at)
        nearest = apart.argmin(axis=1)
        rows = np.arange(len(points))
        own = apart[rows, nearest]
        if len(self.at) == 1:
            return nearest, own, np.full(len(points), np.inf)
        apart[rows, nearest] = np.iinfo(np.int64).max
        gap = np.sqrt(apart.min(axis=1).astype(np.float64)) - np.sqrt(own.astype(np.float64))
        return nearest, own, gap + self.drift[nearest]


def expired(cluster: np.ndarray, raised: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Pop from each cluster's heap the rows whose raised gap the accumulated drift has reached."""
    order = np.argsort(cluster, kind="stable")
    ends = np.searchsorted(cluster[order], np.arange(len(drift) + 1))
    popped: list[int] = []
    for j, reached in enumerate(drift):
        rows = order[ends[j] : ends[j + 1]]
        heap = list(zip(raised[rows].tolist(), rows.tolist()))
        heapq.heapify(heap)
        while heap and heap[0][0] <= reached + SLACK * (1 + reached):
            popped.append(heapq.heappop(heap)[1])
    return np.array(popped, np.int64)


def _state(ids: pa.Array, points: np.ndarray, cluster, was, raised) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids,
            lists(points.astype(np.int32).ravel(), np.full(len(points), points.shape[1]), pa.int32()),
            pa.array(cluster.astype(np.int32)),
            pa.array(was.astype(np.int32)),
            pa.array(raised),
        ],
        names=["vec_id", "v", "cluster", "was", "raised"],
    )


def _begin(rows: DataFrame, now: Centroids) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(column(batch, "v")).astype(np.int64)
                cluster, _, raised = now.rescan(points)
                yield _state(column(batch, "vec_id"), points, cluster, np.full(len(points), -1), raised)

    return arrow_map(rows, assign, STATE)


def _again(state: DataFrame, now: Centroids) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(column(batch, "v")).astype(np.int64)
                was = column(batch, "cluster").to_numpy()
                raised = column(batch, "raised").to_numpy().copy()
                cluster = was.copy()
                popped = expired(was, raised, now.drift)
                if len(popped):
                    cluster[popped], _, raised[popped] = now.rescan(points[popped])
                yield _state(column(batch, "vec_id"), points, cluster, was, raised)

    return arrow_map(state.select("vec_id", "v", "cluster", "raised"), assign, STATE)


def changes(state: DataFrame, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """What the vectors that changed cluster add to each cluster's count and sums."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                points = matrix(column(batch, "v")).astype(np.int64)
                if total is None:
                    total = np.zeros((k, points.shape[1]), np.int64)
                for name, sign in (("cluster", 1), ("was", -1)):
                    to = column(batch, name).to_numpy()
                    rows = np.flatnonzero(to >= 0)
                    np.add.at(total, to[rows], sign * points[rows])
                    count += sign * np.bincount(to[rows], minlength=k)
        if total is not None:
            width = total.shape[1]
            flat = np.concatenate([count[:, None], total], axis=1).ravel()
            place = np.tile(np.arange(-1, width), k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(k), width + 1).astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(flat),
                ],
                names=["cluster", "place", "added"],
            )

    moved = state.filter("cluster <> was").select("v", "cluster", "was")
    parts = arrow_map(moved, add_up, "cluster int, place int, added long")
    whole = F.sum(F.col("added").cast("decimal(38,0)")).alias("added")
    rows = parts.groupBy("cluster", "place").agg(whole).collect()
    width = 1 + max((r["place"] for r in rows), default=-1)
    count, sums = np.zeros(k, np.int64), [[0] * width for _ in range(k)]
    for r in rows:
        if r["place"] < 0:
            count[r["cluster"]] = int(r["added"])
        else:
            sums[r["cluster"]][r["place"]] = int(r["added"])
    return count, sums


def _measured(state: DataFrame, now: Centroids) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(column(batch, "v")).astype(np.int64)
                apart = points - now.at[column(batch, "cluster").to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "vec_id"), column(batch, "cluster"), pa.array((apart * apart).sum(axis=1))],
                    names=["vec_id", "cluster", "distance"],
                )

    return arrow_map(state.select("vec_id", "v", "cluster"), measure, "vec_id long, cluster int, distance long")


@dataclass(frozen=True)
class Clustering:
    """(vec_id, cluster, distance) of every vector, and the final centroids by number."""

    rows: DataFrame
    centroids: list[list[int]]


def cluster(rows: DataFrame, k: int, rounds: int, seed: int = 1) -> Clustering:
    """Assign and move ``rounds`` times, then assign once more; ``rows`` as of :func:`whole_vectors`."""
    start = first_centroids(rows, k, seed)
    if not len(start):
        return Clustering(rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    now = Centroids(start, np.zeros(len(start)))
    state = written(_begin(rows, now), "clusters")
    count, sums = np.zeros(len(start), np.int64), [[0] * start.shape[1] for _ in start]
    for _ in range(rounds):
        more, added = changes(state, len(start))
        count = count + more
        if any(map(any, added)) or more.any():
            sums = [[a + b for a, b in zip(s, x)] for s, x in zip(sums, added)]
        to = [[x // int(n) for x in s] if n else c for s, n, c in zip(sums, count, now.at.tolist())]
        now = now.moved(np.array(to, np.int64))
        before, state = state, written(_again(state, now), "clusters")
        release(before)
    return Clustering(_measured(state, now), now.at.tolist())


def with_inertia(found: Clustering) -> DataFrame:
    """Add each cluster's and the whole sum of squared distances and the digest of the centroid."""
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {r["cluster"]: int(r["total"]) for r in found.rows.groupBy("cluster").agg(total).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]

    def by_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster"))

    return found.rows.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([sums.get(j, 0) for j in range(len(digests))], "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        by_cluster(digests, "string").alias("centroid_sha256"),
    )
