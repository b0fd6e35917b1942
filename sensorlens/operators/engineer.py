"""New features from existing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import all_of, quoted, require_columns
from sensorlens.operators.ranks import LOOKUP_BOUND, attach_by_key

AGGREGATES = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "count": F.count,
}


def ratios(df: DataFrame, definitions: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``<num>_per_<den>``; a zero denominator gives a missing value."""
    require_columns(df, [c for pair in definitions for c in pair])
    return df.withColumns(
        {f"{a}_per_{b}": F.try_divide(quoted(a), quoted(b)) for a, b in definitions}
    )


def aggregations(
    df: DataFrame,
    groupby_cols: Sequence[str],
    agg_map: Mapping[str, Sequence[str]],
    bound: int = LOOKUP_BOUND,
) -> DataFrame:
    """Add group statistics ``<column>_<stat>_by_<keys>`` to every row of the group.

    Groups are aggregated before the exchange and come back by a keyed join, so no task
    ever holds the rows of one group.
    """
    require_columns(df, [*groupby_cols, *agg_map])
    suffix = "_by_" + "_".join(groupby_cols)
    key = "_group"
    keyed = df.withColumn(
        key,
        F.when(
            all_of([quoted(c).isNotNull() for c in groupby_cols]),
            F.to_json(F.struct(*[quoted(c) for c in groupby_cols]))
            if len(groupby_cols) > 1
            else quoted(groupby_cols[0]),
        ),
    )
    stats = (
        keyed.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("*").alias("_n"),
            *[
                AGGREGATES[how](quoted(c)).alias(f"{c}_{how}{suffix}")
                for c, hows in agg_map.items()
                for how in hows
            ],
        )
    )
    return attach_by_key(keyed, stats, key, bound).drop(key, "_n")


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the product of every pair of columns."""
    require_columns(df, columns)
    return df.withColumns(
        {f"{a}_x_{b}": quoted(a) * quoted(b) for a, b in combinations(columns, 2)}
    )


def polynomial_terms(columns: Sequence[str], degree: int) -> list[tuple[str, ...]]:
    """Monomials of degree 2..degree, with repetition."""
    return [
        t for d in range(2, degree + 1) for t in combinations_with_replacement(columns, d)
    ]


def polynomial_name(term: Sequence[str]) -> str:
    powers = {c: term.count(c) for c in term}
    return "_".join(c if p == 1 else f"{c}_pow{p}" for c, p in powers.items())


def polynomial_features(df: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    """Add all monomials of degree 2..``degree``; the columns themselves are degree 1."""
    require_columns(df, columns)
    added = {}
    for term in polynomial_terms(columns, degree):
        product = quoted(term[0]).cast("double")
        for c in term[1:]:
            product = product * quoted(c)
        added[polynomial_name(term)] = product
    return df.withColumns(added)
