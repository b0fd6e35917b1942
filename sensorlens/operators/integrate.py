"""Bringing several tables together: merge, concatenate, align types, resolve conflicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlens.functions.columns import any_of, quoted, require_columns
from sensorlens.operators.keys import HOT_KEY_SHARE, SALT, SALTS, _suffixed, hot_keys, salted_copies, salted_rows
from sensorlens.operators.ranks import attach_by_key
from sensorlens.operators.select import rename_columns

MERGE_KINDS = ("inner", "left", "right")


def dataset_merging(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_share: float | None = HOT_KEY_SHARE,
    salts: int = SALTS,
):
    """Join on shared keys; clashing columns get ``_x`` and ``_y``.

    Keys that hold ``hot_share`` of either side are spread over ``salts`` partitions, their
    partner rows are repeated for each; ``None`` leaves skew to the optimizer.
    """
    if how not in MERGE_KINDS:
        raise ValueError(f"how must be one of {MERGE_KINDS}, got {how}")
    if not on:
        raise ValueError("at least one join key is needed")
    require_columns(left, on, "join_key of left")
    require_columns(right, on, "join_key of right")
    left, right = _suffixed(left, right, on)
    keyless = any_of([quoted(c).isNull() for c in on])
    # rows without a key match nothing: they stay out of the join and are added if kept
    kept, other = (left, right) if how != "right" else (right, left)
    joined = _spread_join(left.filter(~keyless), right.filter(~keyless), on, how, hot_share, salts)
    if how == "inner":
        return joined
    added = {f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in on}
    return joined.unionByName(kept.filter(keyless).withColumns(added).select(*joined.columns))


def _spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, share: float | None, salts: int
) -> DataFrame:
    """Join of rows that all have keys, hot keys of either side spread over salts."""
    on = list(on)
    code = None if share is None else _key_code(left, right, on)
    if code is None:
        return left.join(right, on, how)
    kept, other = (left, right) if how != "right" else (right, left)
    hot_kept = hot_keys(kept.select(code.alias("k")), "k", share)
    hot_other = [k for k in hot_keys(other.select(code.alias("k")), "k", share) if k not in hot_kept]

    def joined(kept: DataFrame, other: DataFrame, kind: str) -> DataFrame:
        x, y = (kept, other) if how != "right" else (other, kept)
        return x.join(y, [*on, SALT], kind).drop(SALT)

    if not hot_kept and not hot_other:
        return left.join(right, on, how)
    spread = code.isin(hot_kept) if hot_kept else F.lit(False)
    main = joined(salted_rows(kept, spread, salts), salted_copies(other, spread, salts), how)
    if not hot_other:
        return main
    # every kept row of a key that is hot on the other side has partners: an inner join keeps it
    apart, every = code.isin(hot_other), F.lit(True)
    main = joined(
        salted_rows(kept.filter(~apart), spread, salts), salted_copies(other.filter(~apart), spread, salts), how
    )
    rest = joined(
        salted_copies(kept.filter(apart), every, salts), salted_rows(other.filter(apart), every, salts), "inner"
    )
    return main.unionByName(rest)


def _key_code(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column | None:
    """A hash of the keys that is equal on both sides for equal keys; none if their types differ in kind."""
    parts = []
    for c in on:
        a, b = left.schema[c].dataType, right.schema[c].dataType
        whole = isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)
        if not whole and (a != b or "map<" in a.simpleString()):
            return None
        parts.append(quoted(c).cast("long") if whole else quoted(c))
    return F.xxhash64(*parts)


def union_concat(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column absent from a part is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def column_renaming(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return rename_columns(df, mapping)


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, dates) and isinstance(b, dates):
        return T.TimestampType()
    return T.StringType()


def datatype_harmonization(parts: Sequence[DataFrame]) -> list[DataFrame]:
    """Cast every shared column to one type that holds all its variants.

    Integers widen to long, mixed numbers to double, dates to timestamp, anything else to
    text. A value that does not convert becomes missing.
    """
    common: dict[str, T.DataType] = {}
    for df in parts:
        for f in df.schema.fields:
            common[f.name] = (
                _common_type(common[f.name], f.dataType) if f.name in common else f.dataType
            )
    return [
        df.select(*[quoted(c).try_cast(common[c]).alias(c) for c in df.columns]) for df in parts
    ]


def pk_fk_mapping(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping[str, str],
    how: str = "inner",
    hot_share: float | None = HOT_KEY_SHARE,
) -> DataFrame:
    """Join ``source`` to ``target`` where source keys carry other names than target keys; hot keys are spread."""
    require_columns(source, mapping, "source key")
    require_columns(target, mapping.values(), "target key")
    renamed = source.withColumnsRenamed(dict(mapping))
    return dataset_merging(renamed, target, list(mapping.values()), how, hot_share)


def orphan_rows(source: DataFrame, target: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Source rows whose key has no target row."""
    keys = target.select(*[quoted(t).alias(s) for s, t in mapping.items()]).distinct()
    return source.join(keys, list(mapping), "left_anti")


def priority_rules(
    sources: Mapping[str, DataFrame],
    key: str,
    rules: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Merge sources on a key; each column takes its first non-missing value in rule order.

    ``rules`` maps a column to source names, best first. A column without a rule follows
    the order of ``sources``. Keys of all sources are kept, and so is every row without a
    key. A source has one row per key; of repeated keys the largest value counts.

    The sources are stacked and merged by one aggregate, so there is a single exchange
    however many sources there are, and it carries one row per key and partition.
    """
    order = list(sources)
    columns: list[str] = []
    for df in sources.values():
        columns += [c for c in df.columns if c != key and c not in columns]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            df.select(
                quoted(key),
                *[quoted(c).alias(f"{name}__{c}") for c in df.columns if c != key],
            )
            for name, df in sources.items()
        ],
    )
    parts = [c for c in stacked.columns if c != key]
    merged = (
        stacked.filter(quoted(key).isNotNull())
        .groupBy(quoted(key).alias(key))
        .agg(*[F.max(quoted(c)).alias(c) for c in parts])
    )
    whole = merged.unionByName(stacked.filter(quoted(key).isNull()))
    picked = []
    for c in columns:
        ranked = [s for s in rules.get(c, order) if c in sources[s].columns]
        picked.append(F.coalesce(*[quoted(f"{s}__{c}") for s in ranked]).alias(c))
    return whole.select(quoted(key), *picked)


def data_enrichment(df: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str]):
    """Add lookup columns to every row; rows without a match keep missing values.

    The lookup must have one row per key. It is broadcast only when its counted size
    allows; see :func:`sensorlens.operators.ranks.attach_by_key`.
    """
    require_columns(lookup, [key, *columns], "lookup column")
    return attach_by_key(df, lookup.select(key, *columns), key)
