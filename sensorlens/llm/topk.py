"""Exact top-k inner products over an impact-ordered index, score at a time.

Rows are dealt into shards. A shard's index holds, for each dimension, its rows in the order of
their component, cut into segments; a segment's impact for a query is the most that any of its
rows gains from the dimension. A query takes segments of all dimensions by descending impact and
adds them to the rows' sums. What a row can still gain is bounded by the next impact of every
dimension. Now and then the rows with the largest sums are scored exactly: their k-th score is a
floor that the answer cannot fall below. A query stops only when all rows but a few are proven
to stay below the floor, or when no segment can add anything; the possible members are then
scored exactly, with whole numbers.

Nulls and repeats: rows without an id or a vector, or with a component that is null or not
finite, take no part; a shorter vector counts as filled up with zeros; rows of the query's id are
its own and are left out; repeated rows of other ids are candidates each, an id that asks more
than once asks with its smallest vector. Ties go to the smaller id. Empty in, empty out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import let_workers_import
from sensorlens.llm.vectors import cells, matrix, one_per_id, ranked

SEGMENTS = 16
ROWS_PER_SHARD = 16_384
QUERIES_PER_BLOCK = 4_096
ROUNDS = 8  # proofs tried over the whole run of segments
FEW = 64  # rows that are scored to find the floor


class ImpactIndex:
    """The rows of one shard, by dimension and falling component, in segments of one length.

    The last segment of a dimension is filled up with a row that does not exist.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        n, width = rows.shape
        self.ids, self.rows = ids, rows
        self.largest = float(np.abs(rows).max(initial=0))
        self.doubles = rows.astype(float)
        pieces = min(SEGMENTS, n)
        length = -(-n // pieces)
        pieces = -(-n // length)
        order = np.argsort(-rows, axis=0, kind="stable").T
        filled = np.full((width, pieces * length), n)
        filled[:, :n] = order
        self.members = filled.reshape(width, pieces, length)
        values = np.zeros((width, pieces * length))
        values[:, :n] = np.take_along_axis(self.doubles.T, order, axis=1)
        self.values = values.reshape(width, pieces, length)
        ends = np.minimum(np.arange(1, pieces + 1) * length, n) - 1
        self.tops, self.bottoms = self.values[:, :, 0], values[:, ends]

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k rows that are not the query's own."""
        possible = self._possible(query.astype(float), own, k)
        possible = possible[self.ids[possible] != own]
        scores = self._exact(possible, query)
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible[best]], scores[best]

    def _exact(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        size = self.largest * float(np.abs(query).max(initial=0)) * max(1, len(query))
        if size < 2**52:  # doubles add such numbers exactly
            return (self.doubles[at] @ query.astype(float)).astype(np.int64)
        return self.rows[at] @ query.astype(np.int64)

    def _possible(self, query: np.ndarray, own: int, k: int) -> np.ndarray:
        n, (width, pieces, _) = len(self.rows), self.members.shape
        weights = query[:, None]
        # the most that a row of each segment gains; for a negative weight they run from the end
        impacts = np.where(weights >= 0, self.tops * weights, self.bottoms[:, ::-1] * weights)
        helpful = int((impacts > 0).sum())
        order = np.argsort(-impacts, axis=None, kind="stable")[:helpful]
        bounds = np.concatenate([np.maximum(impacts, 0.0), np.zeros((width, 1))], axis=1)
        dims = np.arange(width)
        sums, taken, floor = np.zeros(n), np.zeros(width, int), -np.inf
        slack = 1e-12 * self.largest * float(np.abs(query).sum())  # more than rounding can lose
        steps = np.unique(np.linspace(0, helpful, ROUNDS + 1).astype(int))
        for start, end in zip(steps[:-1], steps[1:]):
            d, s = np.divmod(order[start:end], pieces)
            at = np.where(query[d] >= 0, s, pieces - 1 - s)
            gains = self.values[d, at] * weights[d]
            sums += np.bincount(self.members[d, at].ravel(), gains.ravel(), minlength=n + 1)[:n]
            np.maximum.at(taken, d, s + 1)
            ahead = bounds[dims, taken].sum()
            leaders = np.argpartition(-sums, FEW)[:FEW] if n > FEW else np.arange(n)
            leaders = leaders[self.ids[leaders] != own]
            if len(leaders) >= k:
                exact = self._exact(leaders, query)
                floor = max(floor, float(np.partition(exact, len(exact) - k)[len(exact) - k]))
            alive = np.flatnonzero(sums + ahead + slack >= floor)
            if len(alive) <= max(FEW, n // 64):
                return alive
        return np.flatnonzero(sums + slack >= floor)


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``rows`` and ``queries`` (vec_id, v array<bigint>)."""
    let_workers_import(rows.sparkSession)
    placed, asked = cells(rows, one_per_id(queries), ROWS_PER_SHARD, QUERIES_PER_BLOCK)

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if shard.num_rows and block.num_rows:
            width = max(
                int(pa.compute.max(pa.compute.list_value_length(t["v"])).as_py() or 0) for t in (shard, block)
            )
            index = ImpactIndex(shard["vec_id"].to_numpy(), matrix(shard["v"], width))
            for own, query in zip(block["vec_id"].to_numpy(), matrix(block["v"], width)):
                ids, scores = index.search(query, own, k)
                out.append((np.full(len(ids), own), ids, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    found = (
        placed.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )
    return ranked(found, k, F.col("score").desc())
