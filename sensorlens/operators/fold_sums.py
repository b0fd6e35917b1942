"""Search and cross-validation over the whole pipeline from sums per fold.

What a linear model and a Gaussian naive Bayes model learn from rows are sums: so are the means that
missing values are filled with and the scales. One aggregate gathers them per fold; a training
part is the total of the other folds, and every fold, fill, scale and penalty follows on the driver
from small matrices. Nothing is fitted again on rows, and no statistic has seen the fold it is judged on.

The linear sums are products of the values [1, present.., value.., label] per row, a missing value
being 0 and not present: filled and scaled features are linear in these, so are predictions, and
the squared error of a fold is a quadratic form of its own sums. Values are taken from the mean of
all rows first, which keeps the products small; the mean cancels out of every result.

The sums are (2 * features + 2) squared per fold, of classes 3 * features per fold and class: the driver
holds no more, whatever the number of rows. Rows without a label take no part; a row's fold
follows the digest of its key.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import report_frame
from sensorlens.operators.order_stats import quantiles
from sensorlens.operators.prep import IMPUTERS, PreprocessConfig
from sensorlens.operators.split import fold_column

SUMS_PER_AGGREGATE = 400
LINEAR = ("linear_regression", "ridge_regression", "lasso_regression")
SCALES_FROM_SUMS = ("standard", "none")


@dataclass(frozen=True)
class FoldSums:
    """Products of [1, present.., value.., label] summed per fold, and what values were taken from."""

    features: list[str]
    shift: np.ndarray
    label_shift: float
    fills: list[np.ndarray]  # per fold, what its training part fills with
    grams: list[np.ndarray]

    def train(self, fold: int) -> np.ndarray:
        return sum(g for i, g in enumerate(self.grams) if i != fold)


def _placed(df: DataFrame, features: Sequence[str], label: str, folds: int, random_state: int, key: str) -> DataFrame:
    require_columns(df, [*features, label, key])
    if folds < 2:
        raise ValueError(f"at least two folds are needed, got {folds}")
    placed = fold_column(df.filter(quoted(label).isNotNull()), folds, random_state, key)
    values = [quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    return placed.select("fold", quoted(label).alias("y"), *values)


def training_fills(placed: DataFrame, n: int, folds: int, imputer: str) -> list[np.ndarray]:
    """The mean or median of each feature over the rows outside each fold."""
    if imputer not in IMPUTERS:
        raise ValueError(f"numeric_imputer must be one of {IMPUTERS}, got {imputer}")
    outside = {(f, i): F.when(F.col("fold") != f, F.col(f"x{i}")) for f in range(folds) for i in range(n)}
    if imputer == "median":
        named = {f"x{i}@{f}": c for (f, i), c in outside.items()}
        found = quantiles(placed, named, (0.5,))
        fill = {(f, i): found[f"x{i}@{f}"][0] for f, i in outside}
    else:
        row = placed.agg(*[F.avg(c).alias(f"m{f}_{i}") for (f, i), c in outside.items()]).first()
        fill = {(f, i): row[f"m{f}_{i}"] for f, i in outside}
    if any(v is None for v in fill.values()):
        raise ValueError("a feature has no value outside one of the folds")
    return [np.array([fill[f, i] for i in range(n)], float) for f in range(folds)]


def fold_sums(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    folds: int = 5,
    random_state: int = 42,
    key: str = "id",
    imputer: str = "median",
) -> FoldSums:
    """Everything that linear models need to know of each fold."""
    features = list(features)
    placed = _placed(df, features, label, folds, random_state, key)
    d = len(features)
    means = placed.agg(F.avg("y"), *[F.avg(f"x{i}") for i in range(d)]).first()
    shift, label_shift = np.array([m or 0.0 for m in means[1:]], float), float(means[0] or 0.0)
    present = [F.col(f"x{i}").isNotNull().cast("double") for i in range(d)]
    moved = [F.coalesce(F.col(f"x{i}") - F.lit(float(shift[i])), F.lit(0.0)) for i in range(d)]
    parts = [F.lit(1.0), *present, *moved, F.col("y").cast("double") - F.lit(label_shift)]
    wide = placed.select("fold", *[p.alias(f"a{i}") for i, p in enumerate(parts)])
    size = len(parts)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    grams = [np.zeros((size, size)) for _ in range(folds)]
    for begin in range(0, len(pairs), SUMS_PER_AGGREGATE):
        some = pairs[begin : begin + SUMS_PER_AGGREGATE]
        sums = [F.sum(F.col(f"a{i}") * F.col(f"a{j}")).alias(f"s{i}_{j}") for i, j in some]
        for row in wide.groupBy("fold").agg(*sums).collect():
            for i, j in some:
                grams[row["fold"]][i, j] = grams[row["fold"]][j, i] = row[f"s{i}_{j}"] or 0.0
    return FoldSums(features, shift, label_shift, training_fills(placed, d, folds, imputer), grams)


def _features_of(sums: FoldSums, fold: int, gram: np.ndarray, scaling: str) -> np.ndarray:
    """Filled and scaled features as combinations of the summed values, a row per feature."""
    d = len(sums.features)
    fill = sums.fills[fold] - sums.shift
    z = np.zeros((d, gram.shape[0]))
    for i in range(d):
        z[i, 0], z[i, 1 + i], z[i, 1 + d + i] = fill[i], -fill[i], 1.0
    if scaling == "none":
        z[:, 0] += sums.shift
        return z
    n = gram[0, 0]
    centre = z @ gram[:, 0] / n
    z[:, 0] -= centre
    spread = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", z, gram, z) / n, 0))
    tiny = spread <= 1e-9 * np.maximum(np.abs(centre + sums.shift), 1e-300)
    return z / np.where(tiny, 1.0, spread)[:, None]


def _solve(covariance: np.ndarray, with_label: np.ndarray, n: float, kind: str, alpha: float) -> np.ndarray:
    if kind == "lasso_regression":
        return _lasso(covariance, with_label, alpha)
    penalty = alpha / n if kind == "ridge_regression" else 0.0
    return np.linalg.lstsq(covariance + penalty * np.eye(len(with_label)), with_label, rcond=1e-13)[0]


def _lasso(covariance: np.ndarray, with_label: np.ndarray, alpha: float) -> np.ndarray:
    """Coordinate descent on the sums, until no weight moves."""
    w = np.zeros(len(with_label))
    for _ in range(10_000):
        before = w.copy()
        for i in range(len(w)):
            if covariance[i, i] > 0:
                rest = with_label[i] - covariance[i] @ w + covariance[i, i] * w[i]
                w[i] = math.copysign(max(abs(rest) - alpha, 0.0), rest) / covariance[i, i]
        if np.abs(w - before).max(initial=0) <= 1e-12 * max(1.0, np.abs(w).max(initial=0)):
            break
    return w


def fold_error(sums: FoldSums, fold: int, kind: str, alpha: float, scaling: str) -> tuple[float | None, int]:
    """RMSE on a fold of the model of the other folds, and the fold's rows."""
    train, held = sums.train(fold), sums.grams[fold]
    n, rows = train[0, 0], held[0, 0]
    if n == 0:
        raise ValueError(f"no training rows outside fold {fold}")
    if rows == 0:
        return None, 0
    z = _features_of(sums, fold, train, scaling)
    label = np.zeros(train.shape[0])
    label[-1] = 1.0
    means, label_mean = z @ train[:, 0] / n, train[0, -1] / n
    centred = z.copy()
    centred[:, 0] -= means
    own = label.copy()
    own[0] -= label_mean
    w = _solve(centred @ train @ centred.T / n, centred @ train @ own / n, n, kind, alpha)
    miss = own - w @ centred
    return math.sqrt(max(miss @ held @ miss, 0.0) / rows), int(rows)


def linear_candidates(grids: Mapping[str, Sequence[float]]) -> list[tuple[str, float]]:
    """(model, alpha) in the order listed; a linear regression has no alpha and counts once."""
    unknown = [k for k in grids if k not in LINEAR]
    if unknown:
        raise ValueError(f"models must be among {list(LINEAR)}, got {unknown}")
    return [(k, float(a)) for k, alphas in grids.items() for a in (alphas if k != LINEAR[0] else [0.0])]


def chosen_candidates(candidates: Sequence, strategy: str, n_iter: int, random_state: int) -> list:
    """All candidates, or a seeded choice of ``n_iter`` of them."""
    if strategy == "random":
        return random.Random(random_state).sample(list(candidates), min(n_iter, len(candidates)))
    if strategy != "grid":
        raise ValueError(f"strategy must be grid or random, got {strategy}")
    return list(candidates)


def linear_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    grids: Mapping[str, Sequence[float]],
    strategy: str = "grid",
    n_iter: int = 30,
    folds: int = 5,
    random_state: int = 42,
    key: str = "id",
    cfg: PreprocessConfig = PreprocessConfig(),
) -> DataFrame:
    """(candidate, model, alpha, fold, rmse, support): every candidate on every fold.

    Alphas mean what they mean in :func:`sensorlens.operators.model.fit_models`: of ridge they weigh
    against the sum of squared errors, of lasso against half their mean.
    """
    if cfg.scaling not in SCALES_FROM_SUMS:
        raise ValueError(f"sums give the scalings {SCALES_FROM_SUMS}, not {cfg.scaling}: use search_pipeline")
    sums = fold_sums(df, features, label, folds, random_state, key, cfg.numeric_imputer)
    tried = chosen_candidates(linear_candidates(grids), strategy, n_iter, random_state)
    rows = [
        (i, kind, alpha, fold, *fold_error(sums, fold, kind, alpha, cfg.scaling))
        for (i, (kind, alpha)), fold in product(enumerate(tried), range(folds))
    ]
    return report_frame(
        df.sparkSession, rows, "candidate int, model string, alpha double, fold int, rmse double, support long"
    )


def best_candidate(report: DataFrame, score: str = "rmse", lowest: bool = True) -> dict:
    """The candidate with the best mean score over the folds, the first of equals."""
    names = [c for c in report.columns if c not in ("fold", "support", score, "accuracy", "f1_weighted", "rmse", "mae")]
    mean = report.groupBy(*names).agg(F.avg(score).alias(score))
    first = mean.orderBy(F.asc_nulls_last(score) if lowest else F.desc_nulls_last(score), "candidate").first()
    if first is None:
        raise ValueError("no candidate was tried")
    return first.asDict()
