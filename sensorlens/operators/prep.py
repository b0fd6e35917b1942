"""Imputation and scaling whose parameters are fitted on training rows only.

Fitting reads the data once or twice and keeps a handful of numbers per column on the
driver. Applying them is a plain projection, so it never shuffles and is part of the
scan's generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.operators.order_stats import quantiles

IMPUTERS = ("median", "mean")
SCALERS = ("standard", "minmax", "robust", "maxabs", "none")


@dataclass(frozen=True)
class PreprocessConfig:
    numeric_imputer: str = "median"
    scaling: str = "standard"
    feature_range: tuple[float, float] = (0.0, 1.0)


@dataclass(frozen=True)
class NumericPreprocessor:
    """Fitted fill value, centre and divisor per feature, in feature order."""

    features: list[str]
    fill: dict[str, float]
    centre: dict[str, float]
    divisor: dict[str, float]
    scaled: bool = True
    offset: float = 0.0

    def column(self, name: str) -> Column:
        v = F.coalesce(quoted(name).cast("double"), F.lit(self.fill[name]))
        if not self.scaled:
            return v
        v = (v - F.lit(self.centre[name])) / F.lit(self.divisor[name])
        return v + F.lit(self.offset) if self.offset else v

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The features in their order, after any columns to keep; the rest is dropped."""
        require_columns(df, [*keep, *self.features])
        return df.select(
            *[quoted(c) for c in keep], *[self.column(c).alias(c) for c in self.features]
        )

    def stages(self, output: str = "features") -> list:
        """The same step as persistable ML stages ending in a vector column."""

        def term(i: int, name: str) -> str:
            v = f"coalesce(cast(`{name}` as double), cast({self.fill[name]!r} as double))"
            if self.scaled:
                v = (
                    f"({v} - cast({self.centre[name]!r} as double))"
                    f" / cast({self.divisor[name]!r} as double)"
                )
                v += f" + cast({self.offset!r} as double)" if self.offset else ""
            return f"{v} as _f{i}"

        terms = ", ".join(term(i, c) for i, c in enumerate(self.features))
        names = [f"_f{i}" for i in range(len(self.features))]
        return [
            SQLTransformer(statement=f"select *, {terms} from __THIS__"),
            VectorAssembler(inputCols=names, outputCol=output, handleInvalid="error"),
        ]

    def assemble(self, df: DataFrame, output: str = "features") -> DataFrame:
        names = [f"_f{i}" for i in range(len(self.features))]
        return PipelineModel(self.stages(output)).transform(df).drop(*names)


def fit_numeric_preprocessor(
    train: DataFrame, features: Sequence[str], cfg: PreprocessConfig = PreprocessConfig()
) -> NumericPreprocessor:
    """Fit imputation, then scaling of the imputed values, on ``train``."""
    features = list(features)
    require_columns(train, features, "feature")
    if cfg.numeric_imputer not in IMPUTERS:
        raise ValueError(f"numeric_imputer must be one of {IMPUTERS}, got {cfg.numeric_imputer}")
    if cfg.scaling not in SCALERS:
        raise ValueError(f"scaling must be one of {SCALERS}, got {cfg.scaling}")
    fill = fit_fill(train, features, cfg.numeric_imputer)
    imputed = {c: F.coalesce(quoted(c).cast("double"), F.lit(fill[c])) for c in features}
    centre, divisor = fit_scaler(train, imputed, cfg.scaling, cfg.feature_range)
    return NumericPreprocessor(
        features,
        fill,
        centre,
        divisor,
        scaled=cfg.scaling != "none",
        offset=float(cfg.feature_range[0]) if cfg.scaling == "minmax" else 0.0,
    )


def fit_fill(train: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, float]:
    """Median or mean per column; a column without any value has none and is refused."""
    if not columns:
        return {}
    if strategy == "median":
        fill = {c: q[0] for c, q in quantiles(train, columns, (0.5,)).items()}
    elif strategy == "mean":
        row = train.agg(*[F.avg(quoted(c).cast("double")) for c in columns]).first()
        fill = {c: row[i] for i, c in enumerate(columns)}
    else:
        raise ValueError(f"imputation must be one of {IMPUTERS}, got {strategy}")
    empty = [c for c, v in fill.items() if v is None]
    if empty:
        raise ValueError(f"columns without any value cannot be imputed: {empty}")
    return fill


def fit_scaler(
    train: DataFrame,
    columns: Mapping[str, Column],
    method: str,
    feature_range: tuple[float, float] = (0.0, 1.0),
) -> tuple[dict[str, float], dict[str, float]]:
    """Centre and divisor per column; a divisor of zero becomes one.

    standard: mean and population deviation; minmax: minimum and range; robust: median and
    interquartile range; maxabs: zero and the largest magnitude.
    """
    names = list(columns)
    if method == "none" or not names:
        return dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
    if method == "robust":
        quart = quantiles(train, columns, (0.25, 0.5, 0.75))
        pairs = {c: (q2, None if q1 is None else q3 - q1) for c, (q1, q2, q3) in quart.items()}
    else:
        two = {
            "standard": lambda v: (F.avg(v), F.stddev_pop(v)),
            "minmax": lambda v: (F.min(v), F.max(v) - F.min(v)),
            "maxabs": lambda v: (F.lit(0.0), F.max(F.abs(v))),
        }[method]
        aggs = []
        for i, c in enumerate(names):
            a, b = two(columns[c])
            aggs += [a.alias(f"a{i}"), b.alias(f"b{i}")]
        row = train.agg(*aggs).first()
        pairs = {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(names)}
    width = feature_range[1] - feature_range[0] if method == "minmax" else 1.0
    centre = {c: a or 0.0 for c, (a, _) in pairs.items()}
    divisor = {c: (b / width if b else 1.0) for c, (_, b) in pairs.items()}
    return centre, divisor


def impute_columns(
    df: DataFrame, columns: Sequence[str], strategy: str, train: DataFrame | None = None
) -> DataFrame:
    """Fill missing numbers in place with the mean or median of ``train`` (default: ``df``)."""
    fill = fit_fill(df if train is None else train, columns, strategy)
    return df.withColumns(
        {c: F.coalesce(quoted(c).cast("double"), F.lit(fill[c])) for c in columns}
    )


def scale_columns(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    train: DataFrame | None = None,
    feature_range: tuple[float, float] = (0.0, 1.0),
) -> DataFrame:
    """Scale in place; missing values are left out of the fit and stay missing."""
    if method not in SCALERS:
        raise ValueError(f"scaling must be one of {SCALERS}, got {method}")
    values = {c: quoted(c).cast("double") for c in columns}
    centre, divisor = fit_scaler(df if train is None else train, values, method, feature_range)
    offset = feature_range[0] if method == "minmax" else 0.0
    return df.withColumns(
        {
            c: (v - F.lit(centre[c])) / F.lit(divisor[c]) + F.lit(float(offset))
            for c, v in values.items()
        }
    )


def type_casting(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not convert becomes missing."""
    require_columns(df, types)
    return df.withColumns({c: quoted(c).try_cast(t) for c, t in types.items()})


def array_conversion(df: DataFrame, vector: str = "features", output: str = "features") -> DataFrame:
    return df.withColumn(output, vector_to_array(quoted(vector)))


def sparse_dense_format(df: DataFrame, columns: Sequence[str], form: str, output: str = "entries"):
    """Rows as feature arrays: dense keeps all values, sparse only (index, value) of non-zeros."""
    values = F.array(*[F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in columns])
    if form == "dense":
        return df.withColumn(output, values)
    if form != "sparse":
        raise ValueError(f"format must be sparse or dense, got {form}")
    pairs = F.transform(values, lambda v, i: F.struct(i.alias("index"), v.alias("value")))
    return df.withColumn(output, F.filter(pairs, lambda p: p["value"] != 0))
