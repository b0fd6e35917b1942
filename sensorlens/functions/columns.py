"""Schema walks and column expressions. Nothing here starts a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in dataset order, minus ``exclude``. Booleans are not numeric."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[quoted(c) for c in numeric_cols(df, exclude)])


def require_columns(df: DataFrame, columns: Iterable[str], role: str = "column") -> None:
    """Raise ``KeyError`` before any plan is built when a column is absent."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise KeyError(f"{role} {absent} not in columns {df.columns}")


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every Float/Double column, so NULL is the only missing value."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    if not floats:
        return df
    return df.withColumns({c: F.nanvl(quoted(c), F.lit(None)) for c in floats})


def zero_safe_ratio(numerator: Column, denominator: Column) -> Column:
    """A ratio that is 0 where the denominator is 0 (ANSI division would raise)."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def split_digest(key: Column, seed: int) -> Column:
    """Hex digest of key and seed: the same under any partitioning and in any engine."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))


def split_number(key: Column, seed: int) -> Column:
    """The first 13 hex digits of :func:`split_digest` as a 52-bit integer."""
    return F.conv(F.substring(split_digest(key, seed), 1, 13), 16, 10).cast("long")


def hex_threshold(share: float) -> str:
    """8-digit hex text such that ``digest[:8] < text`` holds for ``share`` of all keys."""
    if not 0.0 < share < 1.0:
        raise ValueError(f"share must lie strictly between 0 and 1, got {share}")
    return format(round(share * 16**8), "08x")


def all_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
