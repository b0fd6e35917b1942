"""Linear support vector machines by Newton steps on a hinge whose kink is smoothed less and less.

A search that follows the hinge's own slopes meets its kinks at the optimum (all rows of a class lie on one where features say
nothing); how often it then evaluates the loss depends on the rows, and it may stop far from the optimum. Here each step takes two
passes over blocks of rows: one for slopes and curvature, one that tries many lengths of two directions at once. The second
direction rests on a curvature that bounds the loss from above, so every step lowers the loss. A smoothing of ``eps`` changes
the loss by at most half of it; it ends at ten times the tolerance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACK = 4096  # bytes of rows that travel as one, so that a batch of packs stays small
SLICE = 1 << 22  # bytes of rows that are multiplied at once
NEWTON = [2.0**-i for i in range(11)]  # lengths tried of the steps
BOUNDED = [0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0]
SHRINK = 0.1

Lift = Callable[[np.ndarray], np.ndarray]


class HingeMachine(LinearSVC):
    """``LinearSVC`` with its parameters, objective and model, and with a bounded number of passes."""

    def _fit(self, dataset: DataFrame) -> LinearSVCModel:
        return self.fit_lifted(dataset)

    def fit_lifted(self, dataset: DataFrame, lift: Lift | None = None, size: int = 0) -> LinearSVCModel:
        """The machine of features, or of the ``size`` components that ``lift`` makes of blocks of them: these are made anew in every pass and not kept."""
        rows = dataset.select(F.col(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        moments = Summarizer.metrics("count", "mean", "std").summary(F.col("x"))
        held = rows.groupBy(F.lit("all")).agg(moments.alias("s"), F.count_if(~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False))).alias("odd")).first()
        if held is None:
            raise ValueError("no rows to learn from")
        if held["odd"]:
            raise ValueError(f"a machine needs labels 0 and 1, {held['odd']} rows have others")
        n, mean, std = held["s"]["count"], held["s"]["mean"].toArray(), held["s"]["std"].toArray()
        constant = self.getFitIntercept()
        if lift is None:
            turned = _turned(mean if constant else np.zeros(len(mean)), np.where(std > 0, std, 1.0), std > 0, constant)
            blocks, made = _blocks(rows, turned).persist(), Read(len(mean) + constant)
        else:
            blocks = _blocks(rows, lambda x, sign: np.column_stack([x, sign])).persist()
            mean, std = _moments(blocks, Read(len(mean) + 1, size, lambda x: lift(x[:, :-1])), n)
            turned = _turned(mean if constant else np.zeros(size), np.where(std > 0, std, 1.0), std > 0, constant)
            made = Read(held["s"]["mean"].size + 1, size + constant, lambda x: turned(lift(x[:, :-1]), x[:, -1]))
        unit = np.where(std > 0, std, 1.0)
        penalty = self.getRegParam() / (1.0 if self.getStandardization() else unit**2) * np.ones(len(mean))
        try:
            own = np.append(penalty, 0.0) if constant else penalty
            found = minimise(blocks, n, own, self.getTol(), self.getMaxIter(), made)
        finally:
            blocks.unpersist()
        slopes = found[: len(mean)] / unit
        intercept = found[-1] - float(slopes @ mean) if self.getFitIntercept() else 0.0
        sc = SparkContext._active_spark_context
        made = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel(self.uid, _py2java(sc, DenseVector(slopes)), float(intercept))
        model = self._copyValues(LinearSVCModel(made))
        model._transfer_params_to_java()
        return model


class Read:
    """How rows lie in packs: ``held`` numbers each, of which ``made`` makes ``width``."""

    def __init__(self, held: int, width: int = 0, made: Lift | None = None):
        self.held, self.width, self.made = held, width or held, made


def _turned(centre: np.ndarray, unit: np.ndarray, used: np.ndarray, constant: bool) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Scales rows and turns them round where the label is 0: a row's margin is its product with the coefficients."""

    def turned(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
        x = (x - centre) / unit * used
        if constant:
            x = np.column_stack([x, np.ones(len(x))])
        return x * sign[:, None]

    return turned


def _blocks(rows: DataFrame, made: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Packs of what is made of rows and signs, -1 where the label is 0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = np.ascontiguousarray(made(x, np.where(batch.column(1).to_numpy() > 0, 1.0, -1.0)))
            height = max(1, PACK // (8 * x.shape[1]))
            packs = [x[i : i + height].tobytes() for i in range(0, len(x), height)]
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.binary())], names=["rows"])

    return rows.select(vector_to_array("x").alias("x"), "y").mapInArrow(pack, "rows binary")


def _sums(blocks: DataFrame, read: Read, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """What ``work`` gives for rows, added up over all of them."""
    held, made, step = read.held, read.made, max(1, SLICE // (8 * read.width))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist())).reshape(-1, held)
            for i in range(0, len(rows), step):
                own = rows[i : i + step]
                got = work(own if made is None else made(own))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    parts = blocks.mapInArrow(add, "sums array<double>").select(F.posexplode("sums").alias("at", "x"))
    found = parts.groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(len(found))
    for at, x in found:
        out[at] = x
    return out


def _moments(blocks: DataFrame, read: Read, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of what is read; a component that is the same everywhere has none."""
    mean = _sums(blocks, read, lambda x: x.sum(axis=0)) / n
    squares = _sums(blocks, read, lambda x: ((x - mean) ** 2).sum(axis=0))
    std = np.sqrt(squares / max(1, n - 1))
    return mean, np.where(std > 1e-12 * np.maximum(1e-300, np.abs(mean)), std, 0.0)


def minimise(blocks: DataFrame, n: int, penalty: np.ndarray, tol: float, most: int, read: Read) -> np.ndarray:
    """The coefficients of least mean hinge and penalty."""
    width = len(penalty)
    upper = np.triu_indices(width)

    def square(values: np.ndarray) -> np.ndarray:
        out = np.zeros((width, width))
        out[upper] = values / n
        return out + np.triu(out, 1).T + np.diag(penalty)

    at, eps = np.zeros(width), 1.0
    for _ in range(most):

        def bend(rows: np.ndarray, at: np.ndarray = at, eps: float = eps) -> np.ndarray:
            miss = 1 - rows @ at
            far = np.sqrt(miss * miss + eps * eps)
            own = (rows * (eps * eps / (2 * far**3))[:, None]).T @ rows
            above = (rows * (1 / (2 * far))[:, None]).T @ rows
            return np.concatenate([[(miss + far).sum() / 2], -rows.T @ ((1 + miss / far) / 2), own[upper], above[upper]])

        got = _sums(blocks, read, bend)
        now = got[0] / n + (penalty * at * at).sum() / 2
        slope = got[1 : width + 1] / n + penalty * at
        own, above = (square(x) for x in np.split(got[width + 1 :], 2))
        own += np.eye(width) * (1e-12 * np.trace(own) / width)
        newton, bounded = (-np.linalg.lstsq(x, slope, rcond=None)[0] for x in (own, above))
        tried = np.array([at + t * newton for t in NEWTON] + [at + t * bounded for t in BOUNDED])

        def losses(rows: np.ndarray, tried: np.ndarray = tried, eps: float = eps) -> np.ndarray:
            miss = 1 - rows @ tried.T
            return (miss + np.sqrt(miss * miss + eps * eps)).sum(axis=0) / 2

        after = _sums(blocks, read, losses) / n + (penalty * tried * tried).sum(axis=1) / 2
        best = int(after.argmin())
        gain = now - after[best]
        if gain > 0:
            at = tried[best]
        if gain <= max(eps / 20, tol):
            if eps <= 10 * tol and gain <= tol:
                break
            eps = max(10 * tol, eps * SHRINK)
    return at
