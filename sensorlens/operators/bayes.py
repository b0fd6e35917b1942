"""Gaussian naive Bayes from one aggregate per class, and its search over folds.

Count, mean and squared deviation of a class merge, so the training part of a fold is merged from
the other folds and never read again. Variances are raised by ``var_smoothing`` times the largest variance
of any feature over all rows. The fitted model is Spark ML's own, so it is saved with its pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.classification import NaiveBayesModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators.evaluate import confusion_counts, headline_scores
from sensorlens.operators.fold_sums import _placed, training_fills
from sensorlens.operators.prep import PreprocessConfig


@dataclass(frozen=True)
class ClassMoments:
    """Rows, means and mean squared deviations of the features of one class."""

    n: float
    mean: np.ndarray
    variance: np.ndarray

    def __add__(self, other: ClassMoments) -> ClassMoments:
        n = self.n + other.n
        apart = other.mean - self.mean
        variance = (self.n * self.variance + other.n * other.variance) / n + apart * apart * (self.n * other.n / n**2)
        return ClassMoments(n, self.mean + apart * (other.n / n), variance)

    def filled(self, missing: np.ndarray, rows: float, fill: np.ndarray) -> ClassMoments:
        """The moments of ``rows`` rows whose missing values are all ``fill``."""
        share = missing / rows
        apart = fill - self.mean
        mean = np.where(share < 1, self.mean + apart * share, fill)
        variance = np.where(share < 1, self.variance * (1 - share) + apart * apart * share * (1 - share), 0.0)
        return ClassMoments(rows, mean, variance)


def gaussian_model(spark: SparkSession, classes: Mapping[float, ClassMoments], var_smoothing: float) -> NaiveBayesModel:
    """Spark ML's Gaussian model with given moments; labels must be 0, 1, 2, ..."""
    labels = sorted(classes)
    if labels != list(range(len(labels))):
        raise ValueError(f"labels must be 0, 1, 2, ... without a gap, got {labels}")
    total = reduce(lambda a, b: a + b, classes.values())
    raised = var_smoothing * total.variance.max(initial=0.0)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway

    def flat(values: Sequence[float]):
        out = gateway.new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def matrix(rows: Sequence[np.ndarray]):
        table = np.array(rows)
        return jvm.org.apache.spark.ml.linalg.DenseMatrix(*table.shape, flat(table.T.ravel().tolist()))

    held = [classes[x] for x in labels]
    priors = [np.log(c.n / total.n) for c in held]
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("nb")
    made = jvm.org.apache.spark.ml.classification.NaiveBayesModel(
        uid, jvm.org.apache.spark.ml.linalg.DenseVector(flat(priors)), matrix([c.mean for c in held]),
        matrix([c.variance + raised for c in held]),
    )
    made.set("modelType", "gaussian")
    return NaiveBayesModel(made)


class GaussianBayes(Estimator):
    """Gaussian naive Bayes with a choice of ``var_smoothing``."""

    var_smoothing = Param(Params._dummy(), "var_smoothing", "share of the largest variance", TypeConverters.toFloat)

    def __init__(self, var_smoothing: float = 1e-9):
        super().__init__()
        if var_smoothing < 0:
            raise ValueError(f"var_smoothing must not be negative, got {var_smoothing}")
        self._set(var_smoothing=var_smoothing)

    def _fit(self, dataset: DataFrame) -> NaiveBayesModel:
        summed = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
        classes = {}
        for r in dataset.groupBy("label").agg(summed.alias("s")).collect():
            n = float(r["s"]["count"])
            classes[r["label"]] = ClassMoments(n, r["s"]["mean"].toArray(), r["s"]["variance"].toArray() * (n - 1) / n)
        if not classes:
            raise ValueError("no rows to learn from")
        return gaussian_model(dataset.sparkSession, classes, self.getOrDefault("var_smoothing"))


def bayes_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    smoothings: Sequence[float],
    folds: int = 5,
    random_state: int = 42,
    key: str = "id",
    cfg: PreprocessConfig = PreprocessConfig(scaling="none"),
) -> DataFrame:
    """(candidate, var_smoothing, fold, accuracy, f1_weighted, support) from one aggregate and one scoring pass."""
    if cfg.scaling not in ("none", "standard"):
        raise ValueError(f"moments give the scalings none and standard, not {cfg.scaling}")
    d = len(features)
    placed = materialise(_placed(df, features, label, folds, random_state, key))
    fills = training_fills(placed, d, folds, cfg.numeric_imputer)
    per = [F.count("*").alias("n")]
    for i in range(d):
        per += [F.count(f"x{i}").alias(f"c{i}"), F.avg(f"x{i}").alias(f"m{i}"), F.var_pop(f"x{i}").alias(f"v{i}")]
    rows = placed.groupBy("fold", F.col("y").cast("double").alias("y")).agg(*per).collect()

    def column(part: Sequence, i: int) -> ClassMoments:
        """Moments of the present values of one feature."""
        held = [ClassMoments(float(r[f"c{i}"]), np.array([r[f"m{i}"]]), np.array([r[f"v{i}"]])) for r in part if r[f"c{i}"]]
        return reduce(lambda a, b: a + b, held) if held else ClassMoments(0.0, np.zeros(1), np.zeros(1))

    def moments(fold: int, y: float) -> ClassMoments:
        part = [r for r in rows if r["fold"] != fold and r["y"] == y]
        n = float(sum(r["n"] for r in part))
        each = [column(part, i).filled(np.array([n - sum(r[f"c{i}"] for r in part)]), n, fills[fold][i : i + 1]) for i in range(d)]
        return ClassMoments(n, np.concatenate([e.mean for e in each]), np.concatenate([e.variance for e in each]))

    scored: list[list[Column]] = [[] for _ in smoothings]
    for fold in range(folds):
        classes = {y: moments(fold, y) for y in sorted({r["y"] for r in rows if r["fold"] != fold})}
        if not classes:
            raise ValueError(f"no training rows outside fold {fold}")
        total = reduce(lambda a, b: a + b, classes.values())
        raised = max(total.variance / np.where(total.variance > 0, total.variance, 1.0)) if cfg.scaling == "standard" else total.variance.max()
        own = [F.coalesce(F.col(f"x{i}"), F.lit(float(fills[fold][i]))) for i in range(d)]
        unit = total.variance if cfg.scaling == "standard" else np.ones(d)
        for at, s in enumerate(smoothings):
            best = []
            for y, c in classes.items():
                variance = np.maximum(c.variance + s * raised * np.where(unit > 0, unit, 1.0), 1e-300)
                score = F.lit(float(np.log(c.n / total.n) - 0.5 * np.log(variance).sum()))
                for i in range(d):
                    score = score - (own[i] - F.lit(float(c.mean[i]))) * (own[i] - F.lit(float(c.mean[i]))) / F.lit(float(2 * variance[i]))
                best.append(F.struct((-score).alias("less"), F.lit(float(y)).alias("y")))
            scored[at].append(F.when(F.col("fold") == fold, F.array_min(F.array(*best))["y"]))
    each = F.array(*[F.struct(F.lit(at).alias("candidate"), F.coalesce(*p).alias("prediction")) for at, p in enumerate(scored)])
    long = placed.select("fold", F.col("y").cast("double").alias("label"), F.inline(each))
    counts = confusion_counts(long, by=["candidate", "fold"])
    report = headline_scores(counts, ["candidate", "fold"])
    named = F.create_map(*[x for i, s in enumerate(smoothings) for x in (F.lit(i), F.lit(float(s)))])
    return report.select("candidate", named[F.col("candidate")].alias("var_smoothing"), "fold", "accuracy", "f1_weighted", "support")
