"""Approximate nearest neighbours through robust-pruned directed graphs.

Rows are dealt into shards by a hash of their id, and every shard gets a graph over its different
vectors. Points enter in growing batches: a greedy beam search from the entry point proposes
neighbours for the whole batch at once, relaxed distance pruning keeps the near ones that no
kept neighbour is nearer to by the factor ``ALPHA``, and edges back are added and pruned alike.
Tight clusters fill their lists with their own members, so searches begin at ``HUBS`` points drawn far from each
other, and what cannot be reached from these is linked, part by part, to its nearest reached
point in slots of their own that pruning leaves alone.
The graphs are written down; a query runs a beam search in every shard and the shards' finds are
ranked together by exact distances in double precision.

Equal vectors of a shard are one point with a list of ids, so that a vector which a third of all
rows share neither fills neighbour lists nor hides behind its copies.

Nulls and repeats: rows without an id or a vector, with a component that is null or not finite,
or with no component but zeros take no part; a shorter vector counts as filled up with zeros;
rows of the query's own id are left out; an id that asks more than once asks with its smallest
vector. Ties go to the smaller id. Empty in, empty out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import let_workers_import
from sensorlens.llm.tables import written
from sensorlens.llm.vectors import matrix, one_per_id, ranked

ALPHA = 1.2
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 224
HUBS = 128  # points where searches begin
BRIDGES = 8  # slots for links between parts
EXPANDED = 3  # points of a beam expanded at once
BATCH = 512
SHARD_BYTES = 4 << 20  # vectors of a shard in double precision: 8 192 of 64 components
QUERIES_PER_BLOCK = 2_048


def beam_search(
    points: np.ndarray, nexts: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest points found for all queries at once: ids (-1 where none) and squared distances."""
    n, asked = len(points), len(queries)
    norms, own = np.einsum("ij,ij->i", points, points), np.einsum("ij,ij->i", queries, queries)
    ids = np.full((asked, beam), -1)
    far = np.full((asked, beam), np.inf)
    open_ = np.zeros((asked, beam), bool)
    seen = np.zeros((asked, n), bool)
    start = norms[entries] + own[:, None] - 2 * queries @ points[entries].T
    first = np.argsort(start, axis=1, kind="stable")[:, :beam]
    held = first.shape[1]
    ids[:, :held], open_[:, :held], seen[:, entries] = entries[first], True, True
    far[:, :held] = np.take_along_axis(start, first, axis=1)
    active = np.arange(asked)
    while len(active):
        turn = np.argsort(~open_[active], axis=1, kind="stable")[:, :EXPANDED]
        chosen = np.take_along_axis(open_[active], turn, axis=1)
        at = np.where(chosen, np.take_along_axis(ids[active], turn, axis=1), 0)
        open_[active[:, None], turn] = False
        fresh = np.where(chosen[:, :, None], nexts[at], -1).reshape(len(active), -1)
        fresh.sort(axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        valid = (fresh >= 0) & ~seen[active[:, None], fresh]
        row, col = np.nonzero(valid)
        node = fresh[row, col]
        seen[active[row], node] = True
        cost = np.full(fresh.shape, np.inf)
        cost[row, col] = norms[node] + own[active[row]] - 2 * np.einsum("ij,ij->i", points[node], queries[active[row]])
        all_far = np.concatenate([far[active], cost], axis=1)
        all_ids = np.concatenate([ids[active], np.where(valid, fresh, -1)], axis=1)
        all_open = np.concatenate([open_[active], valid], axis=1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[active] = np.take_along_axis(all_far, best, axis=1)
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        open_[active] = np.take_along_axis(all_open, best, axis=1)
        active = active[open_[active].any(axis=1)]
    return ids, np.maximum(far, 0)


def robust_prune(points: np.ndarray, at: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """Neighbours of the points ``at`` out of the proposed ones (-1: none), at most ``DEGREE``."""
    out = np.full((len(at), DEGREE), -1)
    proposed = np.where(proposed == at[:, None], -1, proposed)
    there = points[np.maximum(proposed, 0)]
    away = ((there - points[at][:, None, :]) ** 2).sum(axis=2)
    away[proposed < 0] = np.inf
    order = np.argsort(away, axis=1, kind="stable")
    away, proposed = np.take_along_axis(away, order, axis=1), np.take_along_axis(proposed, order, axis=1)
    there = np.take_along_axis(there, order[:, :, None], axis=1)
    norms = (there**2).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * there @ there.transpose(0, 2, 1)
    alive = proposed >= 0
    rows = np.arange(len(at))
    for k in range(DEGREE):
        any_left = alive.any(axis=1)
        if not any_left.any():
            break
        pick = alive.argmax(axis=1)
        out[any_left, k] = proposed[rows, pick][any_left]
        alive &= ALPHA**2 * between[rows, pick] > away
        alive[rows, pick] = False
    return out


def spread_points(points: np.ndarray, most: int) -> np.ndarray:
    """The point nearest to the middle, then points drawn by their squared distance to those before."""
    rng = np.random.default_rng(7)
    middle = points.mean(axis=0)
    chosen = [int(((points - middle) ** 2).sum(axis=1).argmin())]
    away = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(most, len(points)) and away.max() > 0:
        at = min(int(np.searchsorted(np.cumsum(away), rng.random() * away.sum(), side="right")), len(points) - 1)
        chosen.append(at if away[at] > 0 else int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        away[chosen] = 0
    return np.array(chosen)


class Graph:
    """A directed graph over different vectors, and the points where searches begin."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.points = points
        self.nexts = np.full((n, DEGREE + BRIDGES), -1)
        self.entries = spread_points(points, HUBS)
        rest = np.random.default_rng(5).permutation(n)
        order = np.concatenate([self.entries, rest[~np.isin(rest, self.entries)]])
        done, size = 1, 1
        while done < n:
            batch = order[done : done + size]
            begun = self.entries[: min(done, len(self.entries))]
            found = beam_search(points, self.nexts, begun, points[batch], BUILD_BEAM)[0]
            if size < BATCH:  # early batches hold much of what there is: they propose each other
                found = np.concatenate([found, np.tile(batch, (len(batch), 1))], axis=1)
            self.nexts[batch, :DEGREE] = robust_prune(points, batch, found)
            self._link_back(batch)
            done += len(batch)
            size = min(BATCH, size * 2)
        self._connect()

    def _reach(self, begin: np.ndarray, reached: np.ndarray) -> np.ndarray:
        """Mark what can be reached from ``begin`` outside ``reached``; the points found."""
        found, front = [], begin[~reached[begin]]
        reached[front] = True
        while len(front):
            found.append(front)
            near = np.unique(self.nexts[front])
            near = near[near >= 0]
            front = near[~reached[near]]
            reached[front] = True
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def _connect(self) -> None:
        """Link every part that cannot be reached both ways with the nearest point that can."""
        reached = np.zeros(len(self.points), bool)
        self._reach(self.entries, reached)
        bridges = self.nexts[:, DEGREE:]
        while not reached.all():
            part = self._reach(np.flatnonzero(~reached)[:1], reached.copy())
            free = np.flatnonzero(reached & (bridges[:, -1] < 0))
            best = (np.inf, -1, -1)
            for begin in range(0, len(part), 256):
                some = part[begin : begin + 256]
                there, here = self.points[free], self.points[some]
                away = (there**2).sum(axis=1) + (here**2).sum(axis=1)[:, None] - 2 * here @ there.T
                row, col = np.unravel_index(away.argmin(), away.shape)
                best = min(best, (float(away[row, col]), int(some[row]), int(free[col])))
            _, inside, outside = best
            for a, b in ((outside, inside), (inside, outside)):
                slots = np.flatnonzero(bridges[a] < 0)
                if len(slots):
                    bridges[a, slots[0]] = b
            self._reach(np.array([inside]), reached)

    def _link_back(self, batch: np.ndarray) -> None:
        to = self.nexts[batch, :DEGREE].ravel()
        source = np.repeat(batch, DEGREE)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        hit, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        added = np.full((len(hit), int(count.max(initial=0))), -1)
        added[np.repeat(np.arange(len(hit)), count), place] = source
        merged = np.concatenate([self.nexts[hit, :DEGREE], added], axis=1)
        merged.sort(axis=1)
        merged[:, 1:][merged[:, 1:] == merged[:, :-1]] = -1
        full = (merged >= 0).sum(axis=1) > DEGREE
        kept = -np.sort(-merged, axis=1)[:, :DEGREE]
        self.nexts[hit[~full], : kept.shape[1]] = kept[~full]
        narrow = -np.sort(-merged[full], axis=1)
        for begin in range(0, int(full.sum()), 256):
            some = slice(begin, begin + 256)
            width = max(DEGREE, int((narrow[some] >= 0).sum(axis=1).max(initial=0)))
            self.nexts[hit[full][some], :DEGREE] = robust_prune(self.points, hit[full][some], narrow[some][:, :width])


def build_graphs(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index: (shard, node, v, ids, nexts, hub), a row per different vector of a shard.

    Shards are as large as memory allows, as a search costs little more in a larger graph.
    """
    let_workers_import(rows.sparkSession)
    whole = rows.agg(F.sum(F.size("v")).alias("n")).first()["n"] or 0
    shards = max(1, math.ceil(8 * whole / shard_bytes))
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    def build(shard: pa.Table) -> pa.Table:
        points, node = np.unique(matrix(shard["v"]), axis=0, return_inverse=True)
        ids = shard["vec_id"].to_numpy()
        order = np.lexsort((ids, node.ravel()))
        sizes = np.bincount(node.ravel(), minlength=len(points))
        graph = Graph(points)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.table(
            {
                "shard": pa.array(np.full(len(points), shard["shard"][0].as_py(), np.int32)),
                "node": pa.array(np.arange(len(points), dtype=np.int32)),
                "v": pa.array(list(points), pa.list_(pa.float64())),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[order])),
                "nexts": pa.array(list(graph.nexts.astype(np.int32)), pa.list_(pa.int32())),
                "hub": pa.array(np.isin(np.arange(len(points)), graph.entries)),
            }
        )

    schema = "shard int, node int, v array<double>, ids array<long>, nexts array<int>, hub boolean"
    return written(placed.groupBy("shard").applyInArrow(build, schema), "graphs")


def search_shard(shard: pa.Table, block: pa.Table, k: int) -> list[tuple[np.ndarray, ...]]:
    """(query ids, ids, distances) per query of what one shard's graph yields."""
    shard = shard.sort_by("node")
    width = max(int(pa.compute.max(pa.compute.list_value_length(t["v"])).as_py() or 0) for t in (shard, block))
    points, queries = matrix(shard["v"], width), matrix(block["v"], width)
    nexts, members = matrix(shard["nexts"], DEGREE + BRIDGES), shard["ids"].to_pylist()
    entries = np.flatnonzero(shard["hub"].to_numpy())
    out = []
    asked = block["vec_id"].to_numpy()
    step = max(1, (32 << 20) // max(1, len(points)))  # what beam_search notes per query and point
    for begin in range(0, len(asked), step):
        some = queries[begin : begin + step]
        found = beam_search(points, nexts, entries, some, max(SEARCH_BEAM, 2 * k))[0]
        for own, query, nodes in zip(asked[begin : begin + step], some, found):
            nodes = nodes[nodes >= 0]
            away = np.sqrt(((points[nodes] - query) ** 2).sum(axis=1))
            near = [(d, i) for d, node in zip(away, nodes) for i in members[node][: k + 1] if i != own]
            near = sorted(near)[:k]
            out.append((np.full(len(near), own), np.array([i for _, i in near], np.int64), np.array([d for d, _ in near])))
    return out


def nearest(graphs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest rows found; the score is the distance."""
    let_workers_import(graphs.sparkSession)
    asking = one_per_id(queries)
    blocks = max(1, math.ceil(asking.count() / QUERIES_PER_BLOCK))
    shards = (graphs.agg(F.max("shard")).first()[0] or 0) + 1
    block = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(blocks)).cast("int")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = asking.withColumn("block", block).withColumn("shard", every_shard)
    placed = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        found = search_shard(shard, block, k) if shard.num_rows and block.num_rows else []
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        columns = [np.concatenate(c) for c in zip(*found)] if found else empty
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    found = (
        placed.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    return ranked(found, k, F.col("score").asc())
