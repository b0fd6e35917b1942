"""Distributions fitted by maximum likelihood from aggregates, and chosen by held-out likelihood.

normal: mean and deviation. gamma: the mean and the mean logarithm are all it needs. Student's t: rounds of
expectation and maximisation, each one aggregate of four sums over the column. Rows are split by the digest of their key; a
family is fitted on one part and judged by its mean log density on the other, in one pass for all families.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import hex_threshold, quoted, require_columns, split_digest
from sensorlens.functions.frames import materialise, report_frame

FAMILIES = ("norm", "t", "gamma")
MOST_FREEDOM = 1e4  # beyond it a t distribution is a normal one
ROUNDS = 40
TOLERANCE = 1e-4  # of loc and scale in units of the scale, and of the freedom; sampling errors are larger
STRIDE = 1.8  # how far the freedom moves along each round's step, below 2 for convergence


def digamma(x: float) -> float:
    """Derivative of the logarithm of the gamma function, for x > 0."""
    shift = 0.0
    while x < 8:
        shift -= 1 / x
        x += 1
    y = 1 / (x * x)
    return shift + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def _root(f, low: float, high: float) -> float:
    """Where a falling function crosses zero, by halving on a logarithmic scale; an end if it does not."""
    if f(low) <= 0:
        return low
    if f(high) >= 0:
        return high
    for _ in range(200):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if f(middle) > 0 else (low, middle)
        if high / low < 1 + 1e-12:
            break
    return math.sqrt(low * high)


@dataclass(frozen=True)
class Fitted:
    """A family with its parameters: loc and scale, and for t and gamma a shape (freedom, exponent)."""

    family: str
    loc: float
    scale: float
    shape: float | None = None

    def log_density(self, x: Column) -> Column:
        """Missing where the family gives no density."""
        if self.family == "gamma":
            flat = -math.lgamma(self.shape) - self.shape * math.log(self.scale)
            return F.when(x > 0, F.lit(flat) + F.log(x) * (self.shape - 1) - x / self.scale)
        z = (x - F.lit(self.loc)) / F.lit(self.scale)
        if self.family == "norm":
            return F.lit(-0.5 * math.log(2 * math.pi) - math.log(self.scale)) - z * z / 2
        v = self.shape
        flat = math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi) - math.log(self.scale)
        return F.lit(flat) - F.log1p(z * z / v) * ((v + 1) / 2)


def fit_normal(values: DataFrame) -> Fitted | None:
    row = values.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    return Fitted("norm", row["m"], row["s"]) if row["s"] else None


def fit_gamma(values: DataFrame) -> Fitted | None:
    """None where a value is not positive or all are equal."""
    row = values.agg(F.avg("x").alias("m"), F.avg(F.log(F.when(F.col("x") > 0, F.col("x")))).alias("l"), F.min("x").alias("low")).first()
    if row["low"] is None or row["low"] <= 0:
        return None
    gap = math.log(row["m"]) - row["l"]
    if gap <= 1e-12:
        return None
    shape = _root(lambda a: math.log(a) - digamma(a) - gap, 1e-8, 1e10)
    return Fitted("gamma", 0.0, row["m"] / shape, shape)


def fit_t(values: DataFrame, rounds: int = ROUNDS) -> Fitted | None:
    start = fit_normal(values)
    if start is None:
        return None
    loc, scale, v = start.loc, start.scale, 10.0
    x = F.col("x")
    for _ in range(rounds):
        z = (x - F.lit(loc)) / F.lit(scale)
        w = F.lit(v + 1) / (F.lit(v) + z * z)
        # sums of differences from the present place keep their digits
        row = values.agg(F.avg(w).alias("w"), F.avg(w * z).alias("wz"), F.avg(w * z * z).alias("wzz"), F.avg(F.log(w) - w).alias("lw")).first()
        step = row["wz"] / row["w"]
        # by the sum of weights, not of rows: the same place in far fewer rounds
        spread = math.sqrt(max(row["wzz"] / row["w"] - step * step, 1e-300))
        flat = 1 + row["lw"] + digamma((v + 1) / 2) - math.log((v + 1) / 2)
        freedom = _root(lambda u: math.log(u / 2) - digamma(u / 2) + flat, 0.05, MOST_FREEDOM)
        moved = max(abs(step), abs(spread - 1), abs(math.log(freedom / v)))
        freedom = min(max(v * (freedom / v) ** STRIDE, 0.05), MOST_FREEDOM)
        loc, scale, v = loc + step * scale, scale * spread, freedom
        if moved < TOLERANCE:
            break
    return Fitted("t", loc, scale, v)


FITS = {"norm": fit_normal, "t": fit_t, "gamma": fit_gamma}


def choose_family(
    df: DataFrame,
    column: str,
    key: str = "id",
    families: Sequence[str] = FAMILIES,
    held_share: float = 0.2,
    random_state: int = 42,
) -> tuple[Fitted | None, DataFrame]:
    """The family with the largest mean log density on held-out rows, and the report on all of them.

    Report: family, loc, scale, shape, log_likelihood (missing where the family does not fit the data), n_train,
    n_held. Missing values take no part; of equal families the first listed wins.
    """
    unknown = [f for f in families if f not in FITS]
    if unknown or not families:
        raise ValueError(f"families must be among {list(FITS)}, got {list(families)}")
    require_columns(df, [column, key])
    value = quoted(column).cast("double")
    held = F.substring(split_digest(quoted(key), random_state), 1, 8) < F.lit(hex_threshold(held_share))
    rows = materialise(df.select(value.alias("x"), F.coalesce(held, F.lit(False)).alias("held")).filter(value.isNotNull() & ~F.isnan(value)))
    train, test = rows.filter("not held"), rows.filter("held")
    fitted = {f: FITS[f](train) for f in families}
    made: Mapping[str, Fitted] = {f: m for f, m in fitted.items() if m is not None}
    n_train = train.count()
    scores = [F.avg(m.log_density(F.col("x"))).alias(f) for f, m in made.items()]
    outside = [F.count_if(m.log_density(F.col("x")).isNull()).alias(f"no_{f}") for f, m in made.items()]
    row = test.agg(F.count("*").alias("n"), *scores, *outside).first().asDict()
    score = {f: row[f] if row[f"no_{f}"] == 0 else None for f in made}
    report = [
        (f, m and m.loc, m and m.scale, m and m.shape, score.get(f), n_train, row["n"]) for f, m in fitted.items()
    ]
    schema = "family string, loc double, scale double, shape double, log_likelihood double, n_train long, n_held long"
    best = max((f for f in made if score[f] is not None), key=lambda f: score[f], default=None)
    return made.get(best), report_frame(df.sparkSession, report, schema)


def residual_family(
    scored: DataFrame, label: str, loc: str = "loc", scale: str = "scale", key: str = "id", families: Sequence[str] = ("norm", "t")
) -> tuple[Fitted | None, DataFrame]:
    """The family of a regression's residuals, in units of each row's own scale."""
    z = (quoted(label).cast("double") - quoted(loc)) / quoted(scale)
    return choose_family(scored.select(quoted(key), z.alias("z")), "z", key, families)
