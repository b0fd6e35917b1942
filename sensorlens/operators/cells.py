"""Trees fitted on weighted cells instead of rows.

A tree sees of a feature only which of ``maxBins`` bins holds it. Rows whose features lie in the same bins (and, for
classes, with the same label) are one cell: its weight is the number of its rows, its label that of the rows or their mean. Impurities,
gains and leaves then follow from the cells as from the rows, so all levels, and all rounds of boosting, read cells, which are
at most as many as the rows and at most as many as the combinations of bins. Cuts are exact quantiles of all rows, or the values
themselves where there are few.

Deep trees of many cells are grown by ``branches``, which keeps them in a table. Forests with bootstrap and boosting on samples draw rows, not cells, and stay with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators import branches
from sensorlens.operators.order_stats import quantiles

LABEL, WEIGHT, BINS = "label", "_weight", "_bins"
CELLS_A_TASK = 20_000
MOST_SIDE_BY_SIDE = 8  # fits that are taken to share the cores


class Bins(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol``: per component of ``inputCol`` the number of its ``cuts`` that lie below the value."""

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "new vector column", TypeConverters.toString)
    cuts = Param(Params._dummy(), "cuts", "ascending cuts per component", TypeConverters.toListListFloat)

    def __init__(self, cuts: Sequence[Sequence[float]] = (), inputCol: str = "features", outputCol: str = BINS):
        super().__init__()
        self._set(cuts=[[float(c) for c in own] for own in cuts], inputCol=inputCol, outputCol=outputCol)

    def names(self) -> list[str]:
        return [f"_bin_{i}" for i in range(len(self.getOrDefault("cuts")))]

    def columns(self, dataset: DataFrame) -> DataFrame:
        """The bins as a column each."""
        values = vector_to_array(self.getOrDefault("inputCol"))
        own = [f"_of{n}" for n in self.names()]
        # a bucket holds its lower end and not its upper one, a bin the upper and not the lower; a component without cuts needs one all the same
        splits = [[-np.inf, *[float(np.nextafter(c, np.inf)) for c in cuts or [0.0]], np.inf] for cuts in self.getOrDefault("cuts")]
        held = dataset.withColumns({n: F.get(values, F.lit(i)) for i, n in enumerate(own)})
        made = Bucketizer(splitsArray=splits, inputCols=own, outputCols=self.names()).transform(held).drop(*own)
        for n in self.names():
            made = made.withMetadata(n, {})  # marked as categories, bins would be split in any order
        return made

    def _transform(self, dataset: DataFrame) -> DataFrame:
        binned = self.columns(dataset)
        return VectorAssembler(inputCols=self.names(), outputCol=self.getOrDefault("outputCol")).transform(binned).drop(*self.names())


def bin_cuts(vectors: DataFrame, bins: int) -> list[list[float]]:
    """At most ``bins - 1`` cuts per component: its values but the last where these are few, else quantiles."""
    first = vectors.select(F.size(vector_to_array("features")).alias("n")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    names = [f"x{i}" for i in range(first["n"])]
    rows = vectors.select(vector_to_array("features").alias("v")).select(*[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(names)])
    guess = rows.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    maybe = [n for n in names if guess[n] <= 2 * bins]  # the guess is within a few percent
    values = rows.agg(*[F.array_sort(F.collect_set(n)).alias(n) for n in maybe]).first() if maybe else {}
    few = {n: values[n] for n in maybe if len(values[n]) <= bins}
    many = [n for n in names if n not in few]
    parts = quantiles(rows, many, [i / bins for i in range(1, bins)]) if many else {}
    cuts = []
    for n in names:
        if n in few:
            cuts.append([float(v) for v in few[n][:-1]])
        else:
            cuts.append(sorted(set(parts[n])))
    return cuts


def suits(est: Estimator) -> bool:
    """Whether an estimator fits the same on cells as on rows."""
    if isinstance(est, GBTRegressor):
        return est.getSubsamplingRate() == 1.0 and est.getLossType() == "squared" and est.getMinInstancesPerNode() == 1
    return isinstance(est, (DecisionTreeClassifier, DecisionTreeRegressor))


class Cells:
    """The cells of one table of vectors, written down once for all ``fits`` estimators that read them.

    Every task of a deep level sends sums of nearly all its nodes, so fits that run side by side take fewer tasks each.
    """

    def __init__(self, vectors: DataFrame, bins: int, classes: bool, fits: int = 1):
        self.stage, self.classes = Bins(bin_cuts(vectors, bins)), classes
        names = self.stage.names()
        binned = self.stage.columns(vectors.select("features", LABEL))
        by = [*names, LABEL] if classes else names
        label = [] if classes else [F.avg(LABEL).alias(LABEL)]
        table = materialise(binned.groupBy(*by).agg(F.count("*").cast("double").alias(WEIGHT), *label))
        odd = F.col(LABEL).isNull() | ((F.col(LABEL) < 0) | (F.col(LABEL) != F.floor(LABEL)) if classes else F.lit(False))
        n, self.rows, self.odd, most = table.agg(F.count("*"), F.sum(WEIGHT), F.count_if(odd), F.max(LABEL)).first()
        self.cells, self.most, self.flat = n, most, table
        parts = max(1, min(vectors.sparkSession.sparkContext.defaultParallelism, -(-n // (CELLS_A_TASK * min(fits, MOST_SIDE_BY_SIDE)))))
        self.table = VectorAssembler(inputCols=names, outputCol=BINS).transform(table).select(BINS, LABEL, WEIGHT).repartition(parts)

    def grow(self, ests: Sequence[Estimator]) -> list[list[Transformer]] | None:
        """The stages of estimators that differ in their depth alone, from one tree kept in a table; ``None`` where the driver can hold it."""
        classes = int(self.most or 0) + 1 if self.classes else 0
        if self.odd or not branches.suits(ests, self.cells, classes):
            return None
        grown = branches.Grown(self.flat, self.stage.names(), max(ests, key=lambda e: e.getMaxDepth()), self.cells, classes)
        return [[branches.BranchTree(self.stage, grown, e.getMaxDepth())] for e in ests]

    def fit(self, est: Estimator) -> list[Transformer] | None:
        """The stages that bin and predict; ``None`` where leaves are to hold half of the rows and more, which cells cannot state."""
        least = est.getMinInstancesPerNode()
        share = (least - 0.5) / self.rows if least > 1 else 0.0
        if share >= 0.5:
            return None
        changed = {est.featuresCol: BINS, est.weightCol: WEIGHT, est.minInstancesPerNode: 1, est.minWeightFractionPerNode: share}
        return [self.stage, est.copy(changed).fit(self.table)]
