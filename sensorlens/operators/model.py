"""Fitting, tuning and applying Spark ML models."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from sensorlens.functions.columns import quoted
from sensorlens.functions.frames import materialise, report_frame
from sensorlens.operators import branches, cells, forests
from sensorlens.operators.bayes import GaussianBayes
from sensorlens.operators.evaluate import (
    confusion_counts,
    headline_scores,
    regression_scores,
    top_k,
)
from sensorlens.operators.fold_sums import chosen_candidates
from sensorlens.operators.hinge import HingeMachine
from sensorlens.operators.kernel import DRAWS, KernelMachine
from sensorlens.operators.neighbours import NeighbourClassifier, NeighbourRegressor
from sensorlens.operators.prep import (
    NumericPreprocessor,
    PreprocessConfig,
    fit_numeric_preprocessor,
)
from sensorlens.operators.split import fold_column

# Estimators whose penalty weighs against the sum over all rows, not their mean.
PENALTY_PER_TABLE = ("ridge_regression", "svm_classifier")
MAX_TREE_DEPTH = 30  # the deepest tree Spark ML grows; stands for "no limit"
LABEL = "label"
FITS_AT_ONCE = 4  # trees on the same cells that are fitted side by side
FOLDS_AT_ONCE = 5  # folds of a search that are fitted and scored side by side


def _known(kind: str, params: dict) -> None:
    """Refuse parameters without an equivalent; threads are Spark's affair."""
    params.pop("n_jobs", None)
    if params:
        raise ValueError(f"unknown {kind} parameters {sorted(params)}")


def _only(params: dict, name: str, accepted: Sequence) -> None:
    """Accept a parameter only where it asks for what is done anyway."""
    if params.get(name, accepted[0]) not in accepted:
        raise ValueError(f"{name} must be one of {list(accepted)}, got {params[name]!r}")
    params.pop(name, None)


def _tree(params: dict, impurities: Mapping[str, str]) -> dict:
    depth = params.pop("max_depth", None)
    _only(params, "min_samples_split", [2])  # Spark ML bounds the rows of leaves, not of split nodes
    out = {
        "maxDepth": MAX_TREE_DEPTH if depth is None else min(depth, MAX_TREE_DEPTH),
        "minInstancesPerNode": params.pop("min_samples_leaf", 1),
        "maxBins": params.pop("max_bins", 32),
        "seed": params.pop("random_state", 42),
        "maxMemoryInMB": 512,
    }
    if "criterion" in params:
        criterion = params.pop("criterion")
        if criterion not in impurities:
            raise ValueError(f"criterion must be one of {sorted(impurities)}, got {criterion!r}")
        out["impurity"] = impurities[criterion]
    if "n_estimators" in params:
        out["numTrees"] = params.pop("n_estimators")
    if "bootstrap" in params:
        out["bootstrap"] = params.pop("bootstrap")
    if "max_features" in params:
        chosen = params.pop("max_features")
        out["featureSubsetStrategy"] = "all" if chosen is None else str(chosen)
    _known("tree", params)
    return out


def _linear(params: dict, mixing: float) -> dict:
    """Penalties act on the columns as given; scale them first."""
    out = {
        "regParam": params.pop("alpha", 0.0),
        "elasticNetParam": mixing,
        "standardization": False,
        "fitIntercept": params.pop("fit_intercept", True),
        "maxIter": params.pop("max_iter", 100),
        "tol": params.pop("tol", 1e-6),
    }
    params.pop("random_state", None)
    _known("linear", params)
    return out


def _svm(params: dict) -> Estimator:
    kernel, gamma = params.pop("kernel", "linear"), params.pop("gamma", "scale")
    if kernel not in ("linear", "rbf"):
        raise ValueError(f"kernel must be linear or rbf, got {kernel!r}")
    _only(params, "probability", [False, True])
    seed, draws = params.pop("random_state", None), params.pop("n_components", DRAWS)
    out = HingeMachine(
        regParam=1.0 / params.pop("C", 1.0),
        maxIter=params.pop("max_iter", params.pop("maxIter", 100)),
        tol=params.pop("tol", 1e-6),
    )
    _known("svm", params)
    if kernel == "linear":
        return out
    return KernelMachine(out, None if gamma == "scale" else gamma, draws, 42 if seed is None else seed)


def _bayes(params: dict) -> Estimator:
    smoothing = params.pop("var_smoothing", 1e-9)
    _known("naive bayes", params)
    return GaussianBayes(smoothing)


def _column_share(share: float) -> str:
    """All columns or a share of them. Spark ML draws them anew at every node, not once per tree."""
    if not 0 < share <= 1:
        raise ValueError(f"colsample_bytree must be above 0 and at most 1, got {share!r}")
    return "all" if share == 1 else str(float(share))


def _boosted(params: dict) -> GBTRegressor:
    _only(params, "objective", ["reg:squarederror", "squared_error"])
    depth = params.pop("max_depth", 6)
    out = GBTRegressor(
        maxIter=params.pop("n_estimators", 100),
        maxDepth=MAX_TREE_DEPTH if depth is None else depth,
        stepSize=params.pop("learning_rate", 0.1),
        subsamplingRate=params.pop("subsample", 1.0),
        featureSubsetStrategy=_column_share(params.pop("colsample_bytree", 1.0)),
        maxBins=params.pop("max_bins", 32),
        seed=params.pop("random_state", 42),
    )
    _known("boosting", params)
    return out


def _neighbours(params: dict, kind: type) -> Estimator:
    params.pop("random_state", None)
    chosen = {n: params.pop(n) for n in ("n_neighbors", "weights") if n in params}
    _known("nearest neighbour", params)
    return kind(**chosen)


# Names of split criteria, and what Spark ML calls them.
CLASS_IMPURITIES = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}
VALUE_IMPURITIES = {"squared_error": "variance"}

CLASSIFIERS = {
    "decision_tree_classifier": lambda p: DecisionTreeClassifier(**_tree(p, CLASS_IMPURITIES)),
    "random_forest_classifier": lambda p: RandomForestClassifier(
        **_tree({"n_estimators": 100, "max_features": "sqrt", **p}, CLASS_IMPURITIES)
    ),
    "svm_classifier": _svm,
    "naive_bayes_classifier": _bayes,
    "knn_classifier": lambda p: _neighbours(p, NeighbourClassifier),
}

REGRESSORS = {
    "linear_regression": lambda p: LinearRegression(**_linear(p, 0.0)),
    "ridge_regression": lambda p: LinearRegression(**_linear({"alpha": 1.0, **p}, 0.0)),
    "lasso_regression": lambda p: LinearRegression(**_linear({"alpha": 1.0, **p}, 1.0)),
    "polynomial_regression": lambda p: Pipeline(
        stages=[
            PolynomialExpansion(
                degree=p.pop("degree", 2), inputCol="features", outputCol="_powers"
            ),
            LinearRegression(featuresCol="_powers", **_linear(p, 0.0)),
        ]
    ),
    "decision_tree_regressor": lambda p: DecisionTreeRegressor(**_tree(p, VALUE_IMPURITIES)),
    "random_forest_regressor": lambda p: RandomForestRegressor(
        **_tree({"n_estimators": 100, "max_features": "all", **p}, VALUE_IMPURITIES)
    ),
    "boosted_trees_regressor": _boosted,
    "knn_regressor": lambda p: _neighbours(p, NeighbourRegressor),
}


def build_estimators(
    enabled: Mapping[str, Mapping | None], registry: Mapping = CLASSIFIERS
) -> dict[str, Estimator]:
    """Estimators by name, in the listed order. At least one must be named."""
    if not enabled:
        raise ValueError("no estimator enabled")
    unknown = [n for n in enabled if n not in registry]
    if unknown:
        raise ValueError(f"unknown estimators {unknown}; known: {sorted(registry)}")
    return {n: registry[n](dict(p or {})) for n, p in enabled.items()}


def labelled(preprocessor: NumericPreprocessor, df: DataFrame, label: str, keep=()) -> DataFrame:
    """Assembled feature vectors with a double label: the only columns fitting needs."""
    vectors = preprocessor.assemble(df)
    return vectors.select(
        *[quoted(c) for c in keep], quoted(label).cast("double").alias(LABEL), "features"
    )


def fit_models(
    preprocessor: NumericPreprocessor,
    estimators: Mapping[str, Estimator],
    train: DataFrame,
    label: str,
) -> dict[str, PipelineModel]:
    """Fit every estimator; each result scores raw rows (fill, scale, assemble, predict).

    Preprocessing is fitted once. Its vectors are kept for all estimators and released
    after the last one; lost blocks are recomputed from the source. Trees that do not draw rows
    are fitted on cells of equal bins, a few at once; forests on draws from cells where these are few.
    """
    vectors = labelled(preprocessor, train, label).persist()
    try:
        found = _fit_on_cells(vectors, {n: est for n, est in estimators.items() if cells.suits(est)})
        found |= {n: forests.fit(vectors, est) for n, est in estimators.items() if forests.suits(est)}
        fitted = {}
        for name, est in estimators.items():
            kind = name.split("#")[0]
            if kind in PENALTY_PER_TABLE:
                est = est.copy({est.regParam: _penalty_per_row(vectors, est.getRegParam(), kind)})
            fitted[name] = PipelineModel([*preprocessor.stages(), *(found.get(name) or [_flat(est.fit(vectors))])])
        return fitted
    finally:
        vectors.unpersist()


def _fit_on_cells(vectors: DataFrame, estimators: Mapping[str, Estimator]) -> dict[str, list[Transformer] | None]:
    """Stages by name; estimators with equal bins share the table of cells. The deepest, which take longest, begin first."""
    shapes = {n: (est.getMaxBins(), isinstance(est, DecisionTreeClassifier)) for n, est in estimators.items()}
    tables = {shape: cells.Cells(vectors, *shape, n) for shape, n in Counter(shapes.values()).items()}
    found, alike = {}, {}
    for n, est in estimators.items():
        if isinstance(est, (DecisionTreeClassifier, DecisionTreeRegressor)):
            alike.setdefault(branches.shared(est), []).append(n)
    for names in alike.values():
        stages = tables[shapes[names[0]]].grow([estimators[n] for n in names])
        found |= dict(zip(names, stages)) if stages else {}
    deepest = sorted(estimators.keys() - found.keys(), key=lambda n: (-estimators[n].getMaxDepth(), list(estimators).index(n)))
    fits = [inheritable_thread_target(vectors.sparkSession)(partial(tables[shapes[n]].fit, estimators[n])) for n in deepest]
    with ThreadPool(FITS_AT_ONCE) as pool:
        return found | dict(zip(deepest, pool.map(lambda fit: fit(), fits, chunksize=1)))


def _penalty_per_row(vectors: DataFrame, alpha: float, name: str = "ridge_regression") -> float:
    """Spark ML weighs a penalty against the mean error; of a regression label scaled to unit spread."""
    row = vectors.agg(F.count("*").alias("n"), F.stddev_pop(LABEL).alias("spread")).first()
    scale = 1.0 if name == "svm_classifier" else row["spread"] or 1.0
    return alpha / max(1, row["n"]) * scale


def _flat(model: Transformer) -> Transformer:
    return model.bestModel if isinstance(model, CrossValidatorModel) else model


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns to keep and the prediction."""
    return model.transform(df).select(*[quoted(c) for c in keep], "prediction")


def score_models(models: Mapping[str, PipelineModel], df: DataFrame, label: str) -> DataFrame:
    """Predictions of all models over the same rows, one row per (model, row).

    The models are chained over one scan, a prediction column each, and turned into rows last.
    """
    kept = df.columns
    rows = _cut_trees(models, df)
    for i, m in enumerate(models.values()):
        if f"_prediction_{i}" in rows.columns:
            continue
        scored = m.transform(rows)
        held = [c for c in rows.columns if c.startswith("_prediction_")]
        rows = scored.select(
            *[quoted(c) for c in kept], *held, F.col("prediction").alias(f"_prediction_{i}")
        )
    each = [
        F.struct(
            F.lit(name).alias("model"),
            F.lit(i).alias("model_ordinal"),
            quoted(label).cast("double").alias(LABEL),
            F.col(f"_prediction_{i}").alias("prediction"),
        )
        for i, name in enumerate(models)
    ]
    return rows.select(F.inline(F.array(*each)))


def _cut_trees(models: Mapping[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Predictions of models that are cuts of one tree in a table, with one join a tree."""
    alike: dict[int, dict[str, PipelineModel]] = {}
    for i, m in enumerate(models.values()):
        if isinstance(m.stages[-1], branches.BranchTree):
            alike.setdefault(id(m.stages[-1].grown), {})[f"_prediction_{i}"] = m
    for members in alike.values():
        first = next(iter(members.values()))
        names = rows.columns
        vectors = PipelineModel(first.stages[:-1]).transform(rows)
        scored = first.stages[-1].at(vectors, {c: m.stages[-1].depth for c, m in members.items()})
        rows = scored.select(*[quoted(c) for c in names], *members)
    return rows


def evaluate_models(models: Mapping[str, PipelineModel], df: DataFrame, label: str) -> DataFrame:
    """Accuracy and F1 of every model, in one pass over the hold-out."""
    by = ["model", "model_ordinal"]
    return headline_scores(confusion_counts(score_models(models, df, label), by=by), by)


@dataclass(frozen=True)
class BestModel:
    name: str
    model: PipelineModel
    metrics: DataFrame


def select_best(
    models: Mapping[str, PipelineModel], metrics: DataFrame, metric: str = "f1_weighted"
) -> BestModel:
    """Highest score; of equals the first listed."""
    rows = metrics.orderBy(F.desc(metric), "model_ordinal").limit(1).collect()
    name = rows[0]["model"]
    return BestModel(name, models[name], metrics)


def feature_importance(model: PipelineModel, features: Sequence[str], k: int = 30) -> DataFrame | None:
    """Impurity importance of tree models, largest first; ``None`` for other models."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return None
    values = last.featureImportances.toArray()
    return _ranked(features, values, k, "importance")


def coefficients(model: PipelineModel, features: Sequence[str], k: int = 30) -> DataFrame | None:
    """Weights of linear models on the scaled features, largest magnitude first."""
    last = model.stages[-1]
    if not hasattr(last, "coefficients"):
        return None
    rows = [(f, float(v), abs(float(v))) for f, v in zip(features, last.coefficients.toArray(), strict=True)]
    spark = SparkSession.active()
    table = report_frame(spark, rows, "feature string, coefficient double, magnitude double")
    return top_k(table, k, "magnitude")


def _ranked(features: Sequence[str], values, k: int, name: str) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    return top_k(report_frame(SparkSession.active(), rows, f"feature string, {name} double"), k, name)


def parameter_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed Spark ML parameter values."""
    params = [estimator.getParam(n) for n in grid]
    return [dict(zip(params, values)) for values in product(*grid.values())]


def hyperparameter_search(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    vectors: DataFrame,
    key: str = "id",
    scoring: str = "f1_weighted",
    strategy: str = "grid",
    n_iter: int = 30,
    folds: int = 5,
    random_state: int = 42,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Cross-validated search over a grid, or over a seeded choice of ``n_iter`` of it.

    Folds follow the digest of the key, so they do not depend on partitioning.
    """
    choices = chosen_candidates(parameter_grid(estimator, grid), strategy, n_iter, random_state)
    evaluators = {
        "f1_weighted": lambda: MulticlassClassificationEvaluator(metricName="f1"),
        "accuracy": lambda: MulticlassClassificationEvaluator(metricName="accuracy"),
        "neg_root_mean_squared_error": lambda: RegressionEvaluator(metricName="rmse"),
        "neg_mean_absolute_error": lambda: RegressionEvaluator(metricName="mae"),
    }
    if scoring not in evaluators:
        raise ValueError(f"scoring must be one of {sorted(evaluators)}, got {scoring}")
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=choices,
        evaluator=evaluators[scoring](),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=random_state,
    )
    return validator.fit(fold_column(vectors, folds, random_state, key))


def search_pipeline(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    candidates: Sequence[tuple[str, Mapping]],
    registry: Mapping = CLASSIFIERS,
    folds: int = 5,
    random_state: int = 42,
    key: str = "id",
    cfg: PreprocessConfig = PreprocessConfig(),
    strategy: str = "grid",
    n_iter: int = 30,
) -> DataFrame:
    """Scores of every (model, parameters) on every fold, fills and scales fitted outside the fold.

    Parameters are those of :func:`build_estimators` and mean the same as in :func:`fit_models`.
    Columns: candidate, model, params, fold, then accuracy and f1_weighted, or rmse and mae, and support. Models
    whose sums merge are searched without refitting by ``fold_sums`` and ``bayes``.
    """
    tried = chosen_candidates(candidates, strategy, n_iter, random_state)
    made = {
        f"{name}#{i}": build_estimators({name: params}, registry)[name] for i, (name, params) in enumerate(tried)
    }
    if not made:
        raise ValueError("no candidate to try")
    placed = materialise(fold_column(df.filter(quoted(label).isNotNull()), folds, random_state, key))
    by = ["model_ordinal", "fold"]

    def judged(fold: int) -> DataFrame:
        train, held = placed.filter(F.col("fold") != fold), placed.filter(F.col("fold") == fold)
        fitted = fit_models(fit_numeric_preprocessor(train, features, cfg), made, train, label)
        scored = score_models(fitted, held, label).withColumn("fold", F.lit(fold))
        if registry is REGRESSORS:
            return materialise(regression_scores(scored, by=by))
        return materialise(headline_scores(confusion_counts(scored, by=by), by).drop("f1_macro"))

    runs = [inheritable_thread_target(df.sparkSession)(partial(judged, fold)) for fold in range(folds)]
    with ThreadPool(FOLDS_AT_ONCE) as pool:
        report = reduce(DataFrame.unionByName, pool.map(lambda run: run(), runs))
    named = report_frame(
        df.sparkSession,
        [(i, name, "; ".join(f"{k}={v}" for k, v in params.items())) for i, (name, params) in enumerate(tried)],
        "candidate int, model string, params string",
    )
    return named.join(report.withColumnRenamed("model_ordinal", "candidate"), "candidate")


def search_report(search: CrossValidatorModel, scoring: str) -> DataFrame:
    """Mean score per tried parameter set, in the order tried."""
    rows = [
        (i, "; ".join(f"{p.name}={v}" for p, v in tried.items()), float(score))
        for i, (tried, score) in enumerate(
            zip(search.getEstimatorParamMaps(), search.avgMetrics, strict=True)
        )
    ]
    return report_frame(SparkSession.active(), rows, f"candidate int, params string, `{scoring}` double")


def cross_validate(
    estimator: Estimator,
    vectors: DataFrame,
    key: str = "id",
    folds: int = 5,
    random_state: int = 42,
) -> DataFrame:
    """Accuracy and F1 of one estimator on each fold."""
    placed = fold_column(vectors, folds, random_state, key).persist()
    try:
        parts = []
        for k in range(folds):
            model = estimator.fit(placed.filter(F.col("fold") != k))
            parts.append(
                model.transform(placed.filter(F.col("fold") == k)).select(
                    "fold", LABEL, "prediction"
                )
            )
        counts = confusion_counts(reduce(DataFrame.unionByName, parts), by=["fold"])
        rows = headline_scores(counts, ["fold"]).orderBy("fold").collect()
    finally:
        placed.unpersist()
    return report_frame(
        vectors.sparkSession,
        [(r["fold"], r["accuracy"], r["f1_weighted"], r["support"]) for r in rows],
        "fold int, accuracy double, f1_weighted double, support long",
    )


@dataclass(frozen=True)
class NormalRegression:
    """Per-row normal distribution: one model for the mean, one for the size of the residual."""

    location: PipelineModel
    spread: PipelineModel
    floor: float

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        names = [quoted(c) for c in keep]
        located = self.location.transform(df).withColumnRenamed("prediction", "loc")
        located = located.drop(*[c for c in located.columns if c.startswith("_")], "features")
        spread = self.spread.transform(located)
        scale = F.greatest(
            F.col("prediction") * F.lit(HALF_NORMAL_TO_SIGMA), F.lit(self.floor)
        )
        return spread.select(
            *names, F.lit("norm").alias("distribution"), "loc", scale.alias("scale")
        )


HALF_NORMAL_TO_SIGMA = 1.2533141373155001  # sqrt(pi / 2): mean absolute residual to sigma


def fit_probabilistic_regression(
    preprocessor: NumericPreprocessor, estimator: Estimator, train: DataFrame, label: str
) -> NormalRegression:
    vectors = labelled(preprocessor, train, label).persist()
    try:
        mean_model = estimator.fit(vectors)
        residuals = mean_model.transform(vectors).select(
            "features", F.abs(F.col(LABEL) - F.col("prediction")).alias(LABEL)
        )
        spread_model = estimator.fit(residuals)
        typical = residuals.agg(F.avg(LABEL)).first()[0] or 1.0
    finally:
        vectors.unpersist()
    stages = preprocessor.stages()
    return NormalRegression(
        PipelineModel([*stages, mean_model]),
        PipelineModel([*preprocessor.stages(), spread_model]),
        1e-3 * typical,
    )


def batch_scoring(model: PipelineModel, df: DataFrame, key: str = "id") -> DataFrame:
    """(key, prediction) of unlabelled rows."""
    return predict(model, df, [key])
