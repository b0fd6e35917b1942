"""Deep trees of many cells, grown branch by branch in tasks and kept in a table.

A tree without a limit on its depth has about as many nodes as cells, more than a driver holds on large tables. Here the driver grows
the top of the tree level by level from sums over bins, until no node has more than ``BRANCH`` cells; each node left then is the root of a
branch, which one task grows in numpy and writes down as one row. Splits are those of Spark ML (same gains, same order among equals, cuts
between all bins instead of those met in a sample), so the predictions are too.

A tree's upper levels are the tree of a smaller depth, so estimators that differ only in ``maxDepth`` share one. Rows are
scored by their combinations of bins, each of which meets its branch once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted
from sensorlens.functions.frames import let_workers_import, materialise

LEAST_CELLS = 20_000  # trees of fewer cells are left to Spark ML, whose model the driver holds
LEAST_DEPTH = 11  # and so are those of a smaller depth
BRANCH, LEAST_BRANCH = 50_000, 4_000  # cells of a branch at most; fewer where that gives every core some branches
BRANCHES_A_CORE = 4
SUMS_AT_ONCE = 1 << 20  # sums over bins that are searched for splits at once
MOST_CLASSES = 100
EPSILON = 2.0**-52  # purer nodes are not split, as in Spark ML


@dataclass(frozen=True)
class Growth:
    """What decides the splits: impurity, number of bins, depth and weight of a leaf at least. Sums are of weights by class, or of weight, label and its square."""

    kind: str
    bins: int
    depth: int
    least: float

    def weight(self, sums: np.ndarray) -> np.ndarray:
        return sums[..., 0] if self.kind == "variance" else sums.sum(axis=-1)

    def value(self, sums: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return sums[..., 1] / sums[..., 0] if self.kind == "variance" else sums.argmax(axis=-1).astype(float)

    def impurity(self, sums: np.ndarray) -> np.ndarray:
        w = self.weight(sums)
        with np.errstate(divide="ignore", invalid="ignore"):
            if self.kind == "variance":
                return (sums[..., 2] - sums[..., 1] * sums[..., 1] / w) / w
            out = np.ones(w.shape) if self.kind == "gini" else np.zeros(w.shape)
            for i in range(sums.shape[-1]):
                share = sums[..., i] / w
                out -= share * share if self.kind == "gini" else np.where(share > 0, share * (np.log(share) / np.log(2)), 0.0)
            return out

    def splits(self, sums: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of nodes x features x bins x sums the best feature, last bin to its left, gain (not above 0: a leaf) and the sums to its left."""
        left = sums.cumsum(axis=2)[:, :, :-1]
        total = sums[:, 0].sum(axis=1)
        right = total[:, None, None] - left
        w, wl, wr = self.weight(total)[:, None, None], self.weight(left), self.weight(right)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = self.impurity(total)[:, None, None] - wl / w * self.impurity(left) - wr / w * self.impurity(right)
        gain[~((wl > 0) & (wr > 0) & (wl >= self.least) & (wr >= self.least) & (gain >= 0))] = -np.inf
        flat = gain.reshape(len(gain), -1)
        best = flat.argmax(axis=1)
        each = np.arange(len(gain))
        feature, cut = np.divmod(best, gain.shape[2])
        return feature, cut, flat[each, best], left[each, feature, cut]


@dataclass
class Nodes:
    """A tree as arrays; the right child follows the left one, a leaf's feature is -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray = field(repr=False)  # times the weight

    def follow(self, bins: np.ndarray, steps: int, at: np.ndarray) -> np.ndarray:
        """The nodes that rows reach from nodes ``at`` in so many steps."""
        each = np.arange(len(bins))
        for _ in range(steps):
            own = self.feature[at]
            inner = own >= 0
            if not inner.any():
                break
            at = np.where(inner, self.left[at] + (bins[each, own] > self.cut[at]), at)
        return at

    def importances(self, size: int, steps: int, below: dict[int, tuple[float | None, np.ndarray]]) -> tuple[float | None, np.ndarray]:
        """Gains by feature of the tree cut at a depth, and its value if that is the same everywhere: Spark ML merges leaves that agree. ``below``: of branches."""
        depth, split = np.zeros(len(self.value), dtype=int), []
        for i in np.flatnonzero(self.feature >= 0).tolist():
            depth[self.left[i] : self.left[i] + 2] = depth[i] + 1
            if depth[i] < steps:
                split.append(i)
        one = {i: v for i, v in enumerate(self.value.tolist()) if i not in below} | {i: v for i, (v, _) in below.items()}
        total = np.sum([g for _, g in below.values()], axis=0) if below else np.zeros(size)
        for i in reversed(split):
            a, b = one[int(self.left[i])], one[int(self.left[i]) + 1]
            one[i] = a if a == b else None
            if a is None or a != b:
                total[self.feature[i]] += self.gain[i]
        return one[0], total


def _joined(parts: list[tuple[np.ndarray, ...]]) -> Nodes:
    feature, cut, left, value, gain = (np.concatenate(x) for x in zip(*parts))
    return Nodes(feature.astype(np.int16), cut.astype(np.int16), left.astype(np.int32), value, gain)


def _sums(bins: np.ndarray, stats: np.ndarray, at: np.ndarray, nodes: int, width: int) -> np.ndarray:
    out = np.empty((nodes, bins.shape[1], width, stats.shape[1]))
    for f in range(bins.shape[1]):
        place = at * width + bins[:, f]
        for i in range(stats.shape[1]):
            out[:, f, :, i] = np.bincount(place, stats[:, i], nodes * width).reshape(nodes, width)
    return out


def grow(bins: np.ndarray, stats: np.ndarray, how: Growth, depth: int = 0) -> Nodes:
    """The tree of cells whose root lies at a depth."""
    total, parts, ends = stats.sum(axis=0)[None], [], 0
    asked = np.zeros(1, dtype=int) if depth < how.depth else np.zeros(0, dtype=int)
    at = np.zeros(len(bins), dtype=np.int64)  # places among the nodes asked
    step = max(1, SUMS_AT_ONCE // (bins.shape[1] * how.bins * stats.shape[1]))
    while True:
        n = len(total)
        feature, cut, left, gain = np.full(n, -1), np.zeros(n, int), np.zeros(n, int), np.zeros(n)
        children = np.zeros((0, stats.shape[1]))
        if len(asked):
            order = np.argsort(at, kind="stable")
            at, bins, stats = at[order], bins[order], stats[order]
            found = []
            for a in range(0, len(asked), step):
                b = min(a + step, len(asked))
                lo, hi = np.searchsorted(at, [a, b])
                found.append(how.splits(_sums(bins[lo:hi], stats[lo:hi], at[lo:hi] - a, b - a, how.bins)))
            f, c, g, sums = (np.concatenate(x) for x in zip(*found))
            split = g > 0
            own = asked[split]
            feature[own], cut[own], gain[own] = f[split], c[split], g[split] * how.weight(total[own])
            left[own] = ends + n + 2 * np.arange(len(own))
            children = np.stack([sums[split], total[own] - sums[split]], axis=1).reshape(-1, stats.shape[1])
            depth += 1
            more = np.abs(how.impurity(children)) >= EPSILON if depth < how.depth else np.zeros(len(children), dtype=bool)
            place = np.cumsum(split) - 1
            stay = split[at]
            at, bins, stats = at[stay], bins[stay], stats[stay]
            child = 2 * place[at] + (bins[np.arange(len(at)), f[at]] > c[at])
            stay = more[child]
            at, bins, stats = (np.cumsum(more) - 1)[child[stay]], bins[stay], stats[stay]
            asked = np.flatnonzero(more)
        parts.append((feature, cut, left, how.value(total), gain))
        if not len(children):
            return _joined(parts)
        ends, total = ends + n, children


def _bins(batch: pa.RecordBatch | pa.Table, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy().astype(np.int16) for n in names])


def _stats(label: np.ndarray, weight: np.ndarray, classes: int) -> np.ndarray:
    """The sums of cells: weights by class, or weight, label and its square."""
    if not classes:
        return np.column_stack([weight, weight * label, weight * label * label])
    return np.where(label[:, None] == np.arange(classes), weight[:, None], 0.0)


class Grown:
    """A tree grown on a table of cells with columns of bins, a label and a weight."""

    def __init__(self, table: DataFrame, names: Sequence[str], est: Estimator, cells: int, classes: int):
        let_workers_import(table.sparkSession)
        self.names, self.features, self.classes = list(names), len(names), classes
        least = est.getMinInstancesPerNode()
        self.how = Growth(est.getImpurity(), est.getMaxBins(), est.getMaxDepth(), float(least if least > 1 else 0))
        cores = table.sparkSession.sparkContext.defaultParallelism
        self._top(table, max(min(BRANCH, LEAST_BRANCH), min(BRANCH, cells // (cores * BRANCHES_A_CORE))))
        self.branches = self._branches(table, cores) if self.roots else None

    def _top(self, table: DataFrame, most: int) -> None:
        """Splits nodes of more than ``most`` cells; the others are roots of branches, with their depths in ``roots``."""
        spark, names, how, classes = table.sparkSession, self.names, self.how, self.classes
        width = classes or 3
        self.top = Nodes(np.array([-1], np.int16), np.zeros(1, np.int16), np.zeros(1, np.int32), np.zeros(1), np.zeros(1))
        self.roots: dict[int, int] = {}
        asked, depth = [0], 0
        while asked:
            top, level = self.top, depth
            place = np.full(len(top.value), -1)
            place[asked] = np.arange(len(asked))

            def add(batches: Iterator[pa.RecordBatch], top: Nodes = top, level: int = level, place: np.ndarray = place) -> Iterator[pa.RecordBatch]:
                total, nodes = None, int(place.max()) + 1
                for batch in batches:
                    bins = _bins(batch, names)
                    at = place[top.follow(bins, level, np.zeros(len(bins), np.int64))]
                    own = at >= 0
                    stats = _stats(batch.column("label").to_numpy(), batch.column("_weight").to_numpy(), classes)
                    stats = np.column_stack([stats, np.ones(len(stats))])  # and how many cells
                    got = _sums(bins[own], stats[own], at[own], nodes, how.bins)
                    total = got if total is None else total + got
                if total is not None:
                    held = [total[i].tobytes() for i in range(nodes)]
                    yield pa.RecordBatch.from_arrays([pa.array(range(nodes), pa.int32()), pa.array(held, pa.binary())], ["node", "sums"])

            def best(key: tuple, own: pa.Table) -> pa.Table:
                sums = sum(np.frombuffer(x) for x in own.column("sums").to_pylist()).reshape(1, len(names), how.bins, width + 1)
                f, c, g, left = how.splits(np.ascontiguousarray(sums[..., :width]))
                cells = sums[0, f[0], :, width]
                total, before = sums[0, 0, :, :width].sum(axis=0), cells[: c[0] + 1].sum()
                row = [key[0].as_py(), int(f[0]), int(c[0]), float(g[0]), left[0].tolist(), total.tolist(), int(before), int(cells.sum())]
                return pa.table([pa.array([x], t) for x, t in zip(row, FOUND_TYPES)], names=FOUND_NAMES)

            parts = table.select(*names, "label", "_weight").mapInArrow(add, "node int, sums binary")
            found = {r["node"]: r for r in parts.groupBy("node").applyInArrow(best, FOUND).collect()}
            following = []
            for i, node in enumerate(asked):
                r = found[i]
                total = np.array(r["total"])
                if node == 0:
                    top.value[0] = how.value(total)
                    if r["cells"] <= most:
                        self.roots[0] = 0
                        continue
                if r["gain"] <= 0:
                    continue
                sides = np.array([r["left"], total - r["left"]])
                a = len(self.top.value)
                top = self.top
                top.feature[node], top.cut[node], top.left[node], top.gain[node] = r["feature"], r["cut"], a, r["gain"] * how.weight(total)
                both = (np.full(2, -1, np.int16), np.zeros(2, np.int16), np.zeros(2, np.int32), how.value(sides), np.zeros(2))
                self.top = Nodes(*(np.concatenate([x, y]) for x, y in zip((top.feature, top.cut, top.left, top.value, top.gain), both)))
                for side, n in enumerate((r["before"], r["cells"] - r["before"])):
                    if depth + 1 < how.depth and abs(how.impurity(sides[side])) >= EPSILON:
                        if n <= most:
                            self.roots[a + side] = depth + 1
                        else:
                            following.append(a + side)
            asked, depth = following, depth + 1

    def _branches(self, table: DataFrame, cores: int) -> DataFrame:
        """A row per branch: the node that is its root, and its nodes."""
        names, how, classes, top, roots = self.names, self.how, self.classes, self.top, self.roots
        steps = max(roots.values())

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.array(sorted(roots))
            for batch in batches:
                at = top.follow(_bins(batch, names), steps, np.zeros(batch.num_rows, np.int64))
                made = pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "branch"])
                yield made.filter(pa.array(np.isin(at, held)))

        def grown(key: tuple, own: pa.Table) -> pa.Table:
            branch = key[0].as_py()
            stats = _stats(own.column("label").to_numpy(), own.column("_weight").to_numpy(), classes)
            nodes = grow(_bins(own, names), stats, how, roots[branch])
            return pa.table([pa.array([branch], pa.int32()), pa.array([pickle.dumps(nodes)], pa.binary())], names=["branch", "held"])

        cells = table.select(*names, "label", "_weight")
        schema = ", ".join([*[f"{n} double" for n in names], "label double, _weight double, branch int"])
        placed = cells.mapInArrow(place, schema).repartition(max(1, min(len(roots), cores * BRANCHES_A_CORE)), "branch")
        return materialise(placed.groupBy("branch").applyInArrow(grown, "branch int, held binary"))

    def importances(self, depth: int) -> DenseVector:
        """Of the tree cut at a depth, as in Spark ML: gains times weights by feature, their sum 1."""
        size, roots = self.features, self.roots

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for branch, held in zip(batch.column("branch").to_pylist(), batch.column("held")):
                    one, gains = pickle.loads(held.as_py()).importances(size, depth - roots[branch], {})
                    columns = [pa.array([branch], pa.int32()), pa.array([one], pa.float64()), pa.array([gains.tolist()], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["branch", "one", "gains"])

        inside = [b for b, d in roots.items() if d < depth]
        below = {}
        if inside:
            let_workers_import(self.branches.sparkSession)
            found = self.branches.filter(F.col("branch").isin(inside)).mapInArrow(own, "branch int, one double, gains array<double>")
            below = {r["branch"]: (r["one"], np.array(r["gains"])) for r in found.collect()}
        total = self.top.importances(size, depth, below)[1]
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def values(self, combinations: DataFrame, depths: Sequence[int]) -> DataFrame:
        """Rows of bins with ``values``: what the tree cut at each depth predicts."""
        let_workers_import(combinations.sparkSession)
        names, top, roots, depths = self.names, self.top, self.roots, list(depths)
        steps = max(depths, default=0)

        def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.array(sorted(roots), dtype=np.int64)
            for batch in batches:
                bins = _bins(batch, names)
                ends = np.column_stack([top.value[top.follow(bins, d, np.zeros(len(bins), np.int64))] for d in depths])
                at = top.follow(bins, steps, np.zeros(len(bins), np.int64))
                branch = pa.array(np.where(np.isin(at, held), at, -1), pa.int32())
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], branch, _lists(ends)], [*names, "branch", "values"])

        columns = ", ".join(f"{n} double" for n in names)
        placed = combinations.select(*names).mapInArrow(begin, f"{columns}, branch int, values array<double>")
        if not roots:
            return placed.drop("branch")

        def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes, root = None, 0
            for batch in batches:
                branch = batch.column("branch").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(branch)) + 1).tolist(), len(branch)] if len(branch) else [0]
                for a, b in zip(edges, edges[1:]):
                    if batch.column("held")[a].is_valid:
                        nodes, root, a = pickle.loads(batch.column("held")[a].as_py()), roots[int(branch[a])], a + 1
                    if a == b:
                        continue
                    own = batch.slice(a, b - a)
                    bins, values = _bins(own, names), own.column("values").flatten().to_numpy().reshape(b - a, -1).copy()
                    for i, d in enumerate(depths):
                        if d > root:
                            values[:, i] = nodes.value[nodes.follow(bins, d - root, np.zeros(b - a, np.int64))]
                    yield pa.RecordBatch.from_arrays([*[own.column(n) for n in names], _lists(values)], [*names, "values"])

        inside = placed.filter("branch >= 0").withColumn("held", F.lit(None).cast("binary"))
        trees = self.branches.select(*[F.lit(None).cast("double").alias(n) for n in names], "branch", F.lit(None).cast("array<double>").alias("values"), "held")
        # a branch comes before the rows that are to follow it
        dealt = inside.unionByName(trees).repartition("branch").sortWithinPartitions("branch", F.col("held").isNull())
        rest = dealt.mapInArrow(go_on, f"{columns}, values array<double>")
        return placed.filter("branch < 0").drop("branch").unionByName(rest)


FOUND = "node int, feature int, cut int, gain double, left array<double>, total array<double>, before long, cells long"
FOUND_NAMES = [x.split()[0] for x in FOUND.split(", ")]
FOUND_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64()]


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values, dtype=np.float64).ravel()))


class BranchTree(Transformer):
    """Predicts with a tree in a table, cut at a depth; ``stage`` says the bins."""

    def __init__(self, stage: Transformer, grown: Grown, depth: int):
        super().__init__()
        self.stage, self.grown, self.depth = stage, grown, depth

    @property
    def featureImportances(self) -> DenseVector:
        return self.grown.importances(self.depth)

    def at(self, dataset: DataFrame, columns: dict[str, int]) -> DataFrame:
        """Columns of predictions of the tree cut at given depths."""
        names = self.stage.names()
        binned = self.stage.columns(dataset)
        values = self.grown.values(binned.select(*names).distinct(), list(columns.values()))
        found = values.select(*names, *[F.col("values")[i].alias(c) for i, c in enumerate(columns)])
        return binned.join(found, names).select(*[quoted(c) for c in dataset.columns], *columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.at(dataset, {"prediction": self.depth})


def suits(ests: Sequence[Estimator], cells: int, classes: int) -> bool:
    """Whether trees that differ in their depth alone have too many nodes for a driver."""
    if cells < LEAST_CELLS or classes > MOST_CLASSES or max(e.getMaxDepth() for e in ests) < LEAST_DEPTH:
        return False
    return all(e.getMinInfoGain() == 0.0 and e.getMinWeightFractionPerNode() == 0.0 for e in ests)


def shared(est: Estimator) -> tuple:
    """What two estimators must agree in to share a tree."""
    return isinstance(est, DecisionTreeClassifier), est.getMaxBins(), est.getImpurity(), est.getMinInstancesPerNode(), est.getMinInfoGain(), est.getMinWeightFractionPerNode()
