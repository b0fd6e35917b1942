"""Choosing columns and rows, removing constant and duplicate features, change reports."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import all_of, quoted, require_columns
from sensorlens.functions.frames import report_frame, union_all

OCCUPANCY_BITS = 64
COLUMNS_PER_SCAN = 16
SIGNATURE_BITS = 0x7FFFF


class FeatureSelectionResult(NamedTuple):
    df: DataFrame
    removed: list[str]


def drop_after_join(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the listed columns that are present."""
    return df.drop(*columns)


def feature_columns(df: DataFrame, label: str, keys: Iterable[str] = ("id",)) -> list[str]:
    skip = {label, *keys}
    return [c for c in df.columns if c not in skip]


def x_y_separation(
    df: DataFrame, label: str, keys: Iterable[str] = ("id",)
) -> tuple[DataFrame, DataFrame]:
    require_columns(df, [label], "label")
    features = df.select(*[quoted(c) for c in feature_columns(df, label, keys)])
    return features, df.select(quoted(label))


def cast_label(df: DataFrame, label: str) -> DataFrame:
    """Label as int; a missing label stops the job instead of turning into a class."""
    require_columns(df, [label], "label")
    checked = F.when(
        quoted(label).isNull(), F.raise_error(F.lit(f"missing value in label {label}"))
    ).otherwise(quoted(label).cast("int"))
    return df.withColumn(label, checked)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def remove_constant_features(
    df: DataFrame, features: Sequence[str] | None = None, threshold_unique: int = 1
) -> FeatureSelectionResult:
    """Drop features with at most ``threshold_unique`` values, a missing value being one.

    At threshold 1 one aggregate of minimum, maximum and missing count decides. Above it,
    values are first hashed into 64 slots: a column that occupies more slots than the
    threshold certainly has more values. Only the remaining columns, which vary little,
    are counted exactly, so columns of many values are never exchanged.
    """
    features = list(df.columns if features is None else features)
    require_columns(df, features, "feature")
    if not features or threshold_unique < 1:
        return FeatureSelectionResult(df, [])
    if threshold_unique == 1:
        row = df.agg(
            F.count("*").alias("rows"),
            *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(features)],
            *[
                F.min(quoted(c)).eqNullSafe(F.max(quoted(c))).alias(f"same{i}")
                for i, c in enumerate(features)
            ],
        ).first()
        removed = [
            c
            for i, c in enumerate(features)
            if row[f"n{i}"] == 0 or (row[f"same{i}"] and row[f"n{i}"] == row["rows"])
        ]
    else:
        few = _few_slots(df, features, threshold_unique)
        removed = _low_cardinality(df, few, threshold_unique)
    return FeatureSelectionResult(df.drop(*removed), removed)


def _few_slots(df: DataFrame, features: Sequence[str], at_most: int) -> list[str]:
    if at_most >= OCCUPANCY_BITS:
        return list(features)
    one = F.lit(1).cast("long")
    row = df.agg(
        *[
            F.bit_count(
                F.bit_or(
                    F.call_function(
                        "shiftleft",
                        F.when(quoted(c).isNotNull(), one),
                        F.pmod(F.xxhash64(quoted(c)), F.lit(OCCUPANCY_BITS)).cast("int"),
                    )
                )
            ).alias(f"slots{i}")
            for i, c in enumerate(features)
        ]
    ).first()
    return [c for i, c in enumerate(features) if (row[i] or 0) <= at_most]


def _low_cardinality(df: DataFrame, features: Sequence[str], at_most: int) -> list[str]:
    if not features:
        return []
    low = []
    # several exact distinct counts multiply the rows by their number: a few columns at a time
    for start in range(0, len(features), COLUMNS_PER_SCAN):
        batch = features[start : start + COLUMNS_PER_SCAN]
        row = df.agg(
            *[
                (
                    F.count_distinct(quoted(c))
                    + F.coalesce(F.max(quoted(c).isNull().cast("int")), F.lit(0))
                ).alias(f"u{i}")
                for i, c in enumerate(batch)
            ]
        ).first()
        low += [c for i, c in enumerate(batch) if row[i] <= at_most]
    return low


def remove_duplicate_features(
    df: DataFrame, features: Sequence[str] | None = None, strategy: str = "exact"
) -> FeatureSelectionResult:
    """Drop features equal, row by row, to an earlier feature of the same type.

    One aggregate gives every column an order-free signature. Columns that share type and
    signature are then compared row by row, so a signature collision never drops a column.
    """
    if strategy != "exact":
        raise ValueError(f"strategy must be 'exact', got {strategy!r}")
    features = list(df.columns if features is None else features)
    require_columns(df, features, "feature")
    if len(features) < 2:
        return FeatureSelectionResult(df, [])
    types = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(features):
        h = F.xxhash64(quoted(c))
        aggs += [
            F.count(quoted(c)).alias(f"n{i}"),
            F.bit_xor(h).alias(f"x{i}"),
            F.sum(h.bitwiseAND(F.lit(SIGNATURE_BITS))).alias(f"s{i}"),
        ]
    row = df.agg(*aggs).first()
    groups: dict[tuple, list[str]] = {}
    for i, c in enumerate(features):
        groups.setdefault((types[c], *row[3 * i : 3 * i + 3]), []).append(c)
    open_groups = [g for g in groups.values() if len(g) > 1]
    removed: set[str] = set()
    while open_groups:
        pairs = [(g[0], other) for g in open_groups for other in g[1:]]
        equal = df.agg(
            *[
                F.coalesce(F.bool_and(quoted(a).eqNullSafe(quoted(b))), F.lit(True)).alias(f"e{i}")
                for i, (a, b) in enumerate(pairs)
            ]
        ).first()
        same = {b: equal[i] for i, (_, b) in enumerate(pairs)}
        removed |= {b for b, is_same in same.items() if is_same}
        rest = [[c for c in g[1:] if not same[c]] for g in open_groups]
        open_groups = [g for g in rest if len(g) > 1]
    ordered = [c for c in features if c in removed]
    return FeatureSelectionResult(df.drop(*ordered), ordered)


def before_after_kpi(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """One row with the sizes of two frames; both counts run in one job."""
    b, a = before.columns, after.columns
    tags = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return tags.agg(F.sum("b").alias("b"), F.sum("a").alias("a")).select(
        F.lit(step).alias("step"),
        F.coalesce("b", F.lit(0)).cast("long").alias("rows_before"),
        F.lit(len(b)).alias("cols_before"),
        F.coalesce("a", F.lit(0)).cast("long").alias("rows_after"),
        F.lit(len(a)).alias("cols_after"),
        F.lit(len(set(b) - set(a))).alias("cols_removed"),
        F.lit(len(set(a) - set(b))).alias("cols_added"),
    )


def before_after_changes(before: DataFrame, after: DataFrame, step: str) -> DataFrame:
    """One row per removed or added column; a step without changes gives no row."""
    b, a = set(before.columns), set(after.columns)
    rows = [(step, "removed", c) for c in sorted(b - a)]
    rows += [(step, "added", c) for c in sorted(a - b)]
    return report_frame(before.sparkSession, rows, "step string, change string, column string")


def concat_reports(parts: Sequence[DataFrame]) -> DataFrame:
    parts = [p for p in parts if p is not None]
    if not parts:
        raise ValueError("no report to concatenate")
    return union_all(parts)


def manual_include_exclude(
    df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> DataFrame:
    """Keep ``include`` (everything when empty), then drop ``exclude``."""
    require_columns(df, include, "included column")
    kept = df.select(*[quoted(c) for c in include]) if include else df
    return kept.drop(*exclude)


def technical_columns(columns: Iterable[str], patterns: Sequence[str]) -> list[str]:
    """Columns one of whose name parts equals a pattern: ``id`` hits ``row_id``, not ``humidity``."""
    wanted = {p.lower() for p in patterns}
    return [c for c in columns if wanted & set(re.split(r"[^0-9a-z]+", c.lower()))]


def drop_technical_columns(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return df.drop(*technical_columns(df.columns, patterns))


def population_filtering(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Rows for which every SQL rule holds."""
    return df.filter(all_of([F.expr(r) for r in rules])) if rules else df


def time_window_selection(df: DataFrame, time_col: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= time < end``; an open side is ``None``. Text bounds are cast."""
    kind = df.schema[time_col].dataType
    t = quoted(time_col)
    if start is not None:
        df = df.filter(t >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(t < F.lit(end).cast(kind))
    return df


def semantic_based_selection(
    df: DataFrame, keep: Sequence[str], label: str | None = None, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Keep the listed features together with key and label; an empty list keeps all."""
    if not keep:
        return df
    require_columns(df, keep, "kept column")
    chosen = {*keep, *keys, label}
    return df.select(*[quoted(c) for c in df.columns if c in chosen])


def business_rule_filtering(
    df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> DataFrame:
    """Expert rules as name patterns: drop columns matching ``exclude`` unless ``include`` matches."""
    drop = [
        c
        for c in df.columns
        if any(re.fullmatch(p, c) for p in exclude)
        and not any(re.fullmatch(p, c) for p in include)
    ]
    return df.drop(*drop)
