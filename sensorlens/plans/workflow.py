"""The staged work on a feature table X and a label table Y, as plain compositions.

Each stage is lazy until a fit or a report needs data. X and Y are joined once for all stages.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators import evaluate, explain, keys, model, prep, profile, select, split


def understand(
    df: DataFrame, keys_: Sequence[str] = ("id",), bins: int = 30
) -> dict[str, DataFrame]:
    """Report tables about one frame, by name. Nothing is changed."""
    return {
        "describe": profile.describe(df),
        "min_max_mean_std": profile.min_max_mean_std(df, exclude=keys_),
        "dtypes": profile.dtype_analysis(df),
        "cardinality": profile.cardinality_count(df),
        "missing": profile.null_count(df),
        "percentiles": profile.percentile_analysis(df, exclude=keys_),
        "histograms": profile.histograms(df, bins, exclude=keys_),
    }


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    label: str
    features: list[str]
    preprocessor: prep.NumericPreprocessor
    kpi: DataFrame
    changes: DataFrame


def prepare(
    x: DataFrame,
    y: DataFrame,
    key: str = "id",
    label: str = "faulty",
    drop_after_join: Sequence[str] = (),
    threshold_unique: int = 1,
    holdout: split.HoldoutConfig | None = None,
    preprocess: prep.PreprocessConfig = prep.PreprocessConfig(),
) -> Prepared:
    """Join, drop, select, split, and fit fill values and scales on the training rows.

    The joined frame is written down once, because the selection checks, the fits, training
    and scoring all read it.
    """
    holdout = holdout or split.HoldoutConfig(key=key)
    joined = keys.inner_join_x_y(x, y, key)
    joined = select.drop_after_join(joined, [c for c in drop_after_join if c != key])
    joined = materialise(select.cast_label(joined, label))
    candidates = select.feature_columns(joined, label, [key])
    varying = select.remove_constant_features(joined, candidates, threshold_unique).df
    distinct = select.remove_duplicate_features(
        varying, select.feature_columns(varying, label, [key])
    ).df
    features = select.feature_columns(distinct, label, [key])
    train, test = split.split_holdout(distinct, label, holdout)
    steps = [
        ("remove_constant_features", joined, varying),
        ("remove_duplicate_features", varying, distinct),
    ]
    return Prepared(
        train,
        test,
        label,
        features,
        prep.fit_numeric_preprocessor(train, features, preprocess),
        select.concat_reports([select.before_after_kpi(b, a, s) for s, b, a in steps]),
        select.concat_reports([select.before_after_changes(b, a, s) for s, b, a in steps]),
    )


@dataclass(frozen=True)
class Modelled:
    models: Mapping[str, PipelineModel]
    metrics: DataFrame
    report: DataFrame
    best: model.BestModel = field(repr=False)
    counts: DataFrame = field(repr=False)


DEFAULT_MODELS = {"decision_tree_classifier": {}, "random_forest_classifier": {}}


def fit_and_score(
    prepared: Prepared, enabled: Mapping[str, Mapping | None] = DEFAULT_MODELS
) -> Modelled:
    """Fit the enabled classifiers, score the hold-out once with all of them, pick the best.

    Labels and predictions are counted in that one pass and the counts written down: metrics,
    report, choice and the later confusion matrix all come from them.
    """
    estimators = model.build_estimators(enabled)
    models = model.fit_models(
        prepared.preprocessor, estimators, prepared.train, prepared.label
    )
    by = ["model", "model_ordinal"]
    scored = model.score_models(models, prepared.test, prepared.label)
    counts = materialise(evaluate.confusion_counts(scored, by=by))
    metrics = evaluate.headline_scores(counts, by)
    report = evaluate.report_of_counts(counts.drop("model_ordinal"), by=["model"])
    return Modelled(models, metrics, report, model.select_best(models, metrics), counts)


def interpret(
    prepared: Prepared,
    modelled: Modelled,
    k: int = 30,
    n_repeats: int = 10,
    random_state: int = 42,
    normalize: str | None = "true",
) -> dict[str, DataFrame | None]:
    """Importances and the confusion matrix of the best model on the hold-out."""
    best = modelled.best.model
    counts = modelled.counts.filter(F.col("model") == modelled.best.name)
    return {
        "feature_importance": model.feature_importance(best, prepared.features, k),
        "permutation_importance": explain.permutation_importance(
            best, prepared.test, prepared.label, prepared.features, n_repeats, random_state, k
        ),
        "confusion_matrix": evaluate.matrix_of_counts(counts.select("label", "prediction", "n"), normalize),
    }
