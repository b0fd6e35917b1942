"""Categorical columns: filling, encoding, grouping. Encodings are fitted on training rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import materialise
from sensorlens.operators.ranks import LOOKUP_BOUND, attach_by_key, running_totals, value_counts


MOST_FLAGS = 1_000  # categories that get a column each, unless the caller lifts it


def categories(train: DataFrame, column: str, at_most: int | None = MOST_FLAGS) -> list:
    """Distinct non-missing values in order; a column of more than ``at_most`` is refused."""
    values = value_counts(train, column).select(column)
    rows = (values if at_most is None else values.limit(at_most + 1)).collect()
    if at_most is not None and len(rows) > at_most:
        raise ValueError(f"{column} has more than {at_most} categories; use one_hot_vector")
    return sorted(r[0] for r in rows)


def mode_value(train: DataFrame, column: str):
    """Most frequent value, the smallest one among equals; ``None`` without values."""
    return (
        value_counts(train, column)
        .agg(F.min(F.struct((-F.col("n")).alias("minus_n"), quoted(column).alias("v"))).alias("m"))
        .select("m.v")
        .first()[0]
    )


def mode_imputation(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None):
    fills = {c: mode_value(df if train is None else train, c) for c in columns}
    return df.withColumns(
        {c: F.coalesce(quoted(c), F.lit(v)) for c, v in fills.items() if v is not None}
    )


def constant_imputation(df: DataFrame, columns: Sequence[str], value: str = "missing"):
    return df.fillna(value, subset=list(columns))


def one_hot_name(column: str, value) -> str:
    return f"{column}_{re.sub(r'[^0-9A-Za-z]+', '_', str(value))}"


def one_hot_encoding(
    df: DataFrame, column: str, train: DataFrame | None = None, at_most: int | None = MOST_FLAGS
) -> DataFrame:
    """Replace a column by one 0/1 column per training category; unknown values are all 0.

    The frame gets as many columns as there are categories, so more than ``at_most`` are refused
    (``None`` lifts that); :func:`one_hot_vector` holds any number in one sparse column.
    """
    values = categories(df if train is None else train, column, at_most)
    flags = {
        one_hot_name(column, v): F.coalesce((quoted(column) == F.lit(v)).cast("int"), F.lit(0))
        for v in values
    }
    if len(flags) < len(values):
        raise ValueError(f"categories of {column} collide once turned into column names")
    return df.withColumns(flags).drop(column)


@dataclass(frozen=True)
class OneHotVectors:
    """Sparse one-hot vectors over any number of categories, whose codes stay in a table."""

    column: str
    output: str
    codes: DataFrame
    size: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the vector; a value that training has not seen, or none, is all 0."""
        code, index = f"{self.column}_code", f"_{self.output}_index"
        coded = attach_by_key(df, self.codes, self.column, written=True)
        known = coded.withColumn(index, F.coalesce(F.col(code), F.lit(self.size)).cast("double"))
        encoder = OneHotEncoder(inputCols=[index], outputCols=[self.output], dropLast=True)
        widest = df.sparkSession.createDataFrame([(float(self.size),)], [index])
        return encoder.fit(widest).transform(known.drop(code)).drop(index)


def one_hot_vector(train: DataFrame, column: str, output: str) -> OneHotVectors:
    """For columns too wide for :func:`one_hot_encoding`; vector places follow the sorted values."""
    codes = materialise(_codes(train, column, LOOKUP_BOUND).drop("_n"))
    return OneHotVectors(column, output, codes, codes.count())


def _codes(train: DataFrame, column: str, bound: int) -> DataFrame:
    counts = value_counts(train, column).withColumn("one", F.lit(1))
    return running_totals(counts, column, "one", bound).select(
        column, F.col("before").cast("long").alias(f"{column}_code"), F.col("n").alias("_n")
    )


def ordinal_encoding(
    df: DataFrame, column: str, train: DataFrame | None = None, bound: int = LOOKUP_BOUND
) -> DataFrame:
    """Add ``<column>_code``: position among the sorted training categories, from 0."""
    coded = _codes(df if train is None else train, column, bound)
    return attach_by_key(df, coded, column, bound).drop("_n")


def frequency_encoding(
    df: DataFrame,
    column: str,
    min_freq: int = 1,
    train: DataFrame | None = None,
    bound: int = LOOKUP_BOUND,
) -> DataFrame:
    """Add ``<column>_freq``: training rows with that value, 0 when rarer than ``min_freq``."""
    counts = value_counts(df if train is None else train, column)
    joined = attach_by_key(df, counts.withColumnRenamed("n", "_n"), column, bound)
    freq = F.when(F.col("_n") >= min_freq, F.col("_n")).otherwise(F.lit(0)).cast("long")
    return joined.withColumn(f"{column}_freq", freq).drop("_n")


def target_encoding(
    df: DataFrame,
    column: str,
    label: str,
    train: DataFrame,
    bound: int = LOOKUP_BOUND,
) -> DataFrame:
    """Add ``<column>_target``: mean label of the category in ``train``, else the overall mean."""
    require_columns(train, [column, label])
    means = (
        train.filter(quoted(column).isNotNull())
        .groupBy(quoted(column).alias(column))
        .agg(F.avg(label).alias("_mean"), F.count("*").alias("_n"))
    )
    overall = train.agg(F.avg(label)).first()[0]
    joined = attach_by_key(df, means, column, bound)
    return joined.withColumn(f"{column}_target", F.coalesce("_mean", F.lit(overall))).drop(
        "_mean", "_n"
    )


def rare_grouping(
    df: DataFrame,
    column: str,
    min_freq: float = 0.01,
    other: str = "Other",
    train: DataFrame | None = None,
) -> DataFrame:
    """Values with less than ``min_freq`` of the non-missing rows become ``other``."""
    counts = value_counts(df if train is None else train, column)
    total = counts.agg(F.sum("n")).first()[0] or 0
    kept = counts.filter(F.col("n") >= min_freq * total).select(column, F.lit(True).alias("_kept"))
    joined = attach_by_key(df, kept, column)
    grouped = F.when(quoted(column).isNull() | F.col("_kept"), quoted(column))
    return joined.withColumn(column, grouped.otherwise(F.lit(other))).select(*[quoted(c) for c in df.columns])
