"""Cleaning: missing values, outliers, skew, noisy text, duplicate rows."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import all_of, quoted, require_columns
from sensorlens.functions.frames import materialise
from sensorlens.operators.order_stats import quantiles
from sensorlens.operators.prep import fit_fill
from sensorlens.operators.profile import iqr_bounds, is_zscore_outlier, zscore_params

LAMBDA_GRID = tuple(round(-2 + 0.1 * i, 1) for i in range(41))


def drop_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how, subset=list(subset) if subset else None)


def drop_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drop columns whose missing ratio is above ``threshold``."""
    rows = df.agg(F.count("*"), *[F.count(quoted(c)) for c in df.columns]).first()
    total = rows[0]
    gone = [c for c, n in zip(df.columns, rows[1:]) if total and total - n > threshold * total]
    return df.drop(*gone)


def drop_rows_threshold(df: DataFrame, max_na_ratio: float = 0.5) -> DataFrame:
    """Keep rows in which at most ``max_na_ratio`` of the columns are missing."""
    flags = [quoted(c).isNull().cast("int") for c in df.columns]
    missing = flags[0]
    for f in flags[1:]:
        missing = missing + f
    return df.filter(missing <= F.lit(max_na_ratio * len(flags)))


def iterative_imputation(
    df: DataFrame, columns: Sequence[str], rounds: int = 3, reg_param: float = 1e-6
) -> DataFrame:
    """Chained regressions: each column's gaps are predicted from the other columns.

    Starts from the column means and repeats ``rounds`` times. Every round ends in a
    reliable checkpoint, so the plan stays short and lost executors cost one round.
    """
    columns = list(columns)
    if len(columns) < 2:
        raise ValueError("chained imputation needs at least two columns")
    require_columns(df, columns)
    means = fit_fill(df, columns, "mean")
    gaps = {c: f"_gap{i}" for i, c in enumerate(columns)}
    work = df.withColumns({g: quoted(c).isNull() for c, g in gaps.items()})
    with_gaps = work.agg(*[F.max(g).alias(c) for c, g in gaps.items()]).first()
    targets = [c for c in columns if with_gaps[c]]
    work = work.withColumns(
        {c: F.coalesce(quoted(c).cast("double"), F.lit(means[c])) for c in columns}
    )
    if targets and rounds:
        work = materialise(work)  # else every fit of the first round reads the source again
    for _ in range(rounds if targets else 0):
        for target in targets:
            others = [c for c in columns if c != target]
            seen = VectorAssembler(inputCols=others, outputCol="_x").transform(work)
            model = LinearRegression(
                featuresCol="_x", labelCol=target, predictionCol="_guess", regParam=reg_param
            ).fit(seen.filter(~F.col(gaps[target])))
            work = (
                model.transform(seen)
                .withColumn(
                    target,
                    F.when(F.col(gaps[target]), F.col("_guess")).otherwise(quoted(target)),
                )
                .drop("_x", "_guess")
            )
        work = materialise(work)
    return work.drop(*gaps.values())


def _clip(column: Column, lo: float, hi: float) -> Column:
    v = column.cast("double")
    return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(hi)), F.lit(lo)))


def winsorization(
    df: DataFrame, columns: Sequence[str], limits: tuple[float, float] = (0.01, 0.01)
) -> DataFrame:
    """Pull values beyond the lower and upper percentile back to it."""
    found = quantiles(df, columns, (limits[0], 1 - limits[1]))
    return df.withColumns(
        {c: _clip(quoted(c), lo, hi) for c, (lo, hi) in found.items() if lo is not None}
    )


def iqr_clipping(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    bounds = iqr_bounds(df, columns, k)
    return df.withColumns({c: _clip(quoted(c), lo, hi) for c, (lo, hi) in bounds.items()})


def zscore_filtering(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Drop rows with an outlying value in any column; missing values pass."""
    far = [
        F.coalesce(is_zscore_outlier(quoted(c), m, s, threshold), F.lit(False))
        for c, (m, s) in zscore_params(df, columns).items()
    ]
    return df.filter(all_of([~f for f in far]))


def log_transform(
    df: DataFrame, columns: Sequence[str], shift_if_needed: bool = True
) -> DataFrame:
    """log(1 + x), after shifting columns with negative values up to zero."""
    low = df.agg(*[F.min(quoted(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)])
    low = low.first()
    out = {}
    for i, c in enumerate(columns):
        shift = min(low[i] or 0.0, 0.0) if shift_if_needed else 0.0
        out[c] = F.log1p(quoted(c).cast("double") - F.lit(shift))
    return df.withColumns(out)


def box_cox_column(v: Column, lam: float) -> Column:
    return F.log(v) if lam == 0 else (F.pow(v, F.lit(lam)) - 1) / F.lit(lam)


def yeo_johnson_column(v: Column, lam: float) -> Column:
    up = F.log1p(v) if lam == 0 else (F.pow(v + 1, F.lit(lam)) - 1) / F.lit(lam)
    rest = 2 - lam
    down = -F.log1p(-v) if rest == 0 else -(F.pow(1 - v, F.lit(rest)) - 1) / F.lit(rest)
    return F.when(v >= 0, up).otherwise(down)


def fit_power(
    df: DataFrame, columns: Sequence[str], kind: str, grid: Sequence[float] = LAMBDA_GRID
) -> dict[str, float]:
    """Maximum-likelihood exponent per column on a grid, all candidates in one aggregate.

    Of equally likely exponents the one nearest to 1 wins, then the smaller one.
    """
    variants = {"box_cox": box_cox_column, "yeo_johnson": yeo_johnson_column}
    if kind not in variants:
        raise ValueError(f"kind must be box_cox or yeo_johnson, got {kind}")
    aggs = []
    for j, column in enumerate(columns):
        v = quoted(column).cast("double")
        if kind == "box_cox":
            usable = F.when(v > 0, v)
            aggs += [F.avg(F.log(usable)).alias(f"shape{j}"), F.count_if(v <= 0).alias(f"bad{j}")]
        else:
            usable = v
            aggs += [F.avg(F.signum(v) * F.log1p(F.abs(v))).alias(f"shape{j}"), F.lit(0).alias(f"bad{j}")]
        aggs += [F.var_pop(variants[kind](usable, lam)).alias(f"v{j}_{i}") for i, lam in enumerate(grid)]
    row = df.agg(*aggs).first()
    best: dict[str, float] = {}
    for j, column in enumerate(columns):
        if row[f"bad{j}"]:
            raise ValueError(f"box_cox needs positive values; {column} has {row[f'bad{j}']} others")
        if row[f"shape{j}"] is None:
            raise ValueError(f"{column} holds no value")
        scores = []
        for i, lam in enumerate(grid):
            spread = row[f"v{j}_{i}"]
            if spread:
                scores.append((_power_score(lam, row[f"shape{j}"], spread), -abs(lam - 1), -lam, lam))
        best[column] = max(scores)[-1] if scores else 1.0
    return best


def _power_score(lam: float, shape: float, spread: float) -> float:
    return round((lam - 1) * shape - 0.5 * math.log(spread), 12)


def box_cox(df: DataFrame, columns: Sequence[str], lambdas: dict | None = None) -> DataFrame:
    lambdas = lambdas or fit_power(df, columns, "box_cox")
    return df.withColumns(
        {c: box_cox_column(quoted(c).cast("double"), lambdas[c]) for c in columns}
    )


def yeo_johnson(df: DataFrame, columns: Sequence[str], lambdas: dict | None = None) -> DataFrame:
    lambdas = lambdas or fit_power(df, columns, "yeo_johnson")
    return df.withColumns(
        {c: yeo_johnson_column(quoted(c).cast("double"), lambdas[c]) for c in columns}
    )


def fix_typos(
    df: DataFrame, columns: Sequence[str], lowercase: bool = True, regex_cleanup: bool = True
) -> DataFrame:
    """Unify spelling variants: case, stray punctuation, runs of separators."""

    def cleaned(c: Column) -> Column:
        if lowercase:
            c = F.lower(c)
        if regex_cleanup:
            c = F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")
        return F.trim(c)

    return df.withColumns({c: cleaned(quoted(c)) for c in columns})


def accent_map() -> tuple[str, str]:
    """Precomposed Latin letters and their base letters, from the Unicode decompositions."""
    marked, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and parts[0].isalpha():
            marked.append(chr(code))
            plain.append(parts[0])
    return "".join(marked), "".join(plain)


def text_normalization(
    df: DataFrame, columns: Sequence[str], remove_accents: bool = True, fold_case: bool = True
) -> DataFrame:
    """Trim, fold case and strip accents of Latin letters, over the whole text."""
    marked, plain = accent_map()

    def normal(c: Column) -> Column:
        if remove_accents:
            c = F.regexp_replace(F.translate(c, marked, plain), r"[̀-ͯ]", "")
        if fold_case:
            c = F.lower(c)
        return F.trim(c)

    return df.withColumns({c: normal(quoted(c)) for c in columns})


def exact_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: str | None = None
) -> DataFrame:
    """Drop repeated rows. Copies are merged inside each partition before the exchange.

    Without ``subset`` rows equal in all columns become one. With ``subset`` the row with
    the smallest ``order_by`` (then smallest content) of each group is kept.
    """
    if subset is None:
        return df.dropDuplicates()
    require_columns(df, subset)
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.dropDuplicates(list(subset))
    first = [order_by] if order_by else []
    ranked = [*first, *[c for c in rest if c not in first]]
    ranked = [c for c in ranked if c not in subset]
    smallest = F.min(F.struct(*[quoted(c) for c in ranked])).alias("_row")
    kept = df.groupBy(*[quoted(c).alias(c) for c in subset]).agg(smallest)
    return kept.select(
        *[
            quoted(c) if c in subset else F.col("_row").getField(c).alias(c)
            for c in df.columns
        ]
    )
