"""Random Fourier features: a linear machine on them approximates one with an RBF kernel.

``exp(-gamma * |x - y|^2)`` is the mean of ``2 cos(w x + b) cos(w y + b)`` over normal ``w`` and even ``b``. The
draws follow from a seed, so the stage is saved as its few parameters; the work per row is one
matrix product, done for Arrow batches of rows in numpy, and no row has to meet another.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.operators.hinge import HingeMachine

DRAWS = 200


class FourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol``: ``draws`` features whose products approximate the kernel of ``inputCol``."""

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "new vector column", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "components of a vector", TypeConverters.toInt)
    draws = Param(Params._dummy(), "draws", "features drawn", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    def __init__(self, size: int = 1, gamma: float = 1.0, draws: int = DRAWS, seed: int = 42,
                 inputCol: str = "features", outputCol: str = "_fourier"):
        super().__init__()
        self._set(size=size, gamma=float(gamma), draws=draws, seed=seed, inputCol=inputCol, outputCol=outputCol)

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """The drawn directions, a row each, and offsets."""
        get, rng = self.getOrDefault, np.random.default_rng(self.getOrDefault("seed"))
        turns = rng.normal(size=(get("draws"), get("size"))) * np.sqrt(2 * get("gamma"))
        return turns, rng.uniform(0, 2 * np.pi, get("draws"))

    def lift(self) -> Callable[[np.ndarray], np.ndarray]:
        """Makes the features of a block of rows; holds nothing of the session."""
        turns, offsets = self.weights()
        height = float(np.sqrt(2 / len(offsets)))

        def lift(rows: np.ndarray) -> np.ndarray:
            # added up component by component, so that a row's figures do not depend on its batch
            angles = np.zeros((len(rows), len(offsets)))
            for i in range(rows.shape[1]):
                angles += rows[:, i, None] * turns[:, i]
            angles += offsets
            return np.cos(angles, out=angles) * height

        return lift

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lift, draws = self.lift(), self.getOrDefault("draws")

        @F.arrow_udf("array<double>")
        def lifted(own: pa.Array) -> pa.Array:
            made = lift(own.flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1))
            ends = np.arange(0, made.size + 1, draws, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))

        own = vector_to_array(self.getOrDefault("inputCol"))
        return dataset.withColumn(self.getOrDefault("outputCol"), array_to_vector(lifted(own)))


class KernelMachine(Estimator):
    """A linear estimator fitted on Fourier features; without a ``gamma`` one over components times variance."""

    def __init__(self, machine: HingeMachine, gamma: float | None = None, draws: int = DRAWS, seed: int = 42):
        super().__init__()
        if gamma is not None and gamma <= 0:
            raise ValueError(f"gamma must be positive, got {gamma}")
        self.machine, self.gamma, self.draws, self.seed_ = machine, gamma, draws, seed

    @property
    def regParam(self):
        return self.machine.regParam

    def getRegParam(self) -> float:
        return self.machine.getRegParam()

    def copy(self, extra=None) -> KernelMachine:
        return KernelMachine(self.machine.copy(extra), self.gamma, self.draws, self.seed_)

    def _fit(self, dataset: DataFrame):
        own = vector_to_array("features")
        size = dataset.select(F.size(own).alias("n")).first()
        if size is None:
            raise ValueError("no rows to learn from")
        gamma = self.gamma
        if gamma is None:
            spread = dataset.select(F.explode(own).alias("x")).agg(F.var_pop("x")).first()[0]
            gamma = 1.0 / (size["n"] * spread) if spread else 1.0
        lifted = FourierFeatures(size["n"], gamma, self.draws, self.seed_)
        # the features of all rows would be draws over components times as large as the rows
        fitted = self.machine.fit_lifted(dataset, lifted.lift(), self.draws)
        return PipelineModel([lifted, fitted.copy({fitted.featuresCol: "_fourier"})])
