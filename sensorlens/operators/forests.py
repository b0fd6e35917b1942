"""Forests fitted on weighted cells: every tree draws how often each cell's rows are taken.

A row that a forest draws with replacement is taken a Poisson(1) number of times by each tree, and so the n rows of a cell, which
agree in their bins and in their label, are taken Poisson(n) times in all. One number per cell and tree says all that the tree sees of
the draw, whatever the number of rows. The draws are written down once, a column per tree; every tree is a forest of one, fitted on
the cells that it drew with these weights, a few side by side.

Worth it where rows outnumber cells by far: else, and on small tables, the forest is fitted on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from sensorlens.functions.frames import materialise
from sensorlens.operators.cells import BINS, CELLS_A_TASK, LABEL, WEIGHT, Bins, bin_cuts

LEAST_ROWS = 500_000
ROWS_PER_CELL = 4  # on average, for cells to be worth a fit per tree
TREES_AT_ONCE = 8


def suits(est: Estimator) -> bool:
    """Whether an estimator is a forest whose draws can be stated per cell."""
    if not isinstance(est, (RandomForestClassifier, RandomForestRegressor)):
        return False
    return est.getBootstrap() and est.getNumTrees() > 1 and est.getSubsamplingRate() == 1.0 and est.getMinInstancesPerNode() == 1


def fit(vectors: DataFrame, est: Estimator) -> list[Transformer] | None:
    """The stages that bin and predict; ``None`` where the forest is better fitted on the rows."""
    rows = vectors.count()
    if rows < LEAST_ROWS:
        return None
    stage = Bins(bin_cuts(vectors, est.getMaxBins()))
    names = [*stage.names(), LABEL]
    table = materialise(stage.columns(vectors.select("features", LABEL)).groupBy(*names).agg(F.count("*").alias(WEIGHT)))
    n = table.count()
    if n * ROWS_PER_CELL > rows:
        return None
    drawn = _draws(table, names, -(-n // CELLS_A_TASK), est.getNumTrees(), est.getSeed())
    cells = VectorAssembler(inputCols=names[:-1], outputCol=BINS).transform(drawn)
    share = inheritable_thread_target(vectors.sparkSession)
    fits = [share(partial(_tree, cells, est, i)) for i in range(est.getNumTrees())]
    with ThreadPool(TREES_AT_ONCE) as pool:
        return [stage, _forest(est, pool.map(lambda one: one(), fits))]


def _draws(table: DataFrame, names: list[str], parts: int, trees: int, seed: int) -> DataFrame:
    """Cells with a column ``_t0``, ``_t1``, ... per tree; in a fixed order, so that a run repeated draws the same."""
    placed = table.repartition(max(1, parts), *names).sortWithinPartitions(*names)
    schema = ", ".join([*[f"{c} double" for c in names], *[f"_t{i} int" for i in range(trees)]])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed % 2**63, part])
        for batch in batches:
            times = rng.poisson(batch.column(len(names)).to_numpy(), (trees, batch.num_rows)).astype(np.int32)
            own = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(t) for t in times]], [*names, *[f"_t{i}" for i in range(trees)]])

    return materialise(placed.select(*names, WEIGHT).mapInArrow(draw, schema))


def _tree(cells: DataFrame, est: Estimator, i: int) -> Transformer:
    own = cells.select(BINS, LABEL, F.col(f"_t{i}").cast("double").alias(WEIGHT)).filter(F.col(WEIGHT) > 0)
    changed = {est.featuresCol: BINS, est.weightCol: WEIGHT, est.numTrees: 1, est.bootstrap: False, est.seed: est.getSeed() + i}
    return est.copy(changed).fit(own).trees[0]


def _forest(est: Estimator, trees: list[Transformer]) -> Transformer:
    """One model of all trees."""
    sc = SparkContext._active_spark_context
    classes = isinstance(est, RandomForestClassifier)
    package = sc._jvm.org.apache.spark.ml.classification if classes else sc._jvm.org.apache.spark.ml.regression
    kind, one = ("RandomForestClassificationModel", "DecisionTreeClassificationModel") if classes else ("RandomForestRegressionModel", "DecisionTreeRegressionModel")
    held = sc._gateway.new_array(getattr(package, one), len(trees))
    for i, tree in enumerate(trees):
        held[i] = tree._java_obj
    sizes = [trees[0].numFeatures, *([max(t.numClasses for t in trees)] if classes else [])]
    made = getattr(package, kind)(est.uid, held, *sizes)
    model = (RandomForestClassificationModel if classes else RandomForestRegressionModel)(made)
    model = est.copy({est.featuresCol: BINS})._copyValues(model)
    model._transfer_params_to_java()
    return model
