"""Joining features to labels, and the key checks that belong before the join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import long_report, report_frame

HOT_KEY_SHARE = 0.01
SALTS = 32
SALT = "_salt"
TRACKED_KEYS = 10_000
# Fixed value: text shown for a column without description.
MISSING_DESCRIPTION = {"en": "(missing description)"}


def _suffixed(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Clashing non-key columns get ``_x`` and ``_y``."""
    clash = [c for c in x.columns if c in y.columns and c not in keys]
    if not clash:
        return x, y
    return (
        x.withColumnsRenamed({c: f"{c}_x" for c in clash}),
        y.withColumnsRenamed({c: f"{c}_y" for c in clash}),
    )


def hot_keys(df: DataFrame, key: str, share: float = HOT_KEY_SHARE) -> list:
    """Keys that may hold ``share`` of the rows, from one sketch pass over the key column.

    The sketch reports every key above the share; a key it overrates only gets salted in
    vain. The list has at most ``2 / share`` entries.
    """
    if df.schema[key].dataType.typeName() in ("binary", "struct", "array", "map"):
        raise TypeError(f"key {key} has no sketchable type")
    k = int(2 / share)
    row = df.agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {max(TRACKED_KEYS, 4 * k)})").alias("top"),
        F.count(quoted(key)).alias("n"),
    ).first()
    return [r["item"] for r in row["top"] or [] if r["count"] >= share * row["n"] and r["count"] > 1]


def salted_rows(df: DataFrame, spread: Column, salts: int = SALTS) -> DataFrame:
    """Add a salt: a turn over ``salts`` where ``spread`` holds, 0 elsewhere.

    Equal rows are spread too: the salt follows a row's place in its partition, once the rows to
    spread lie in the order of their content. So a task that runs again after a lost executor
    gives the same rows the same salts, in whatever order they reach it.
    """
    hashable = [quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    content = F.when(spread, F.xxhash64(*hashable)) if hashable else F.lit(0)
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    return df.sortWithinPartitions(content).withColumn(SALT, F.when(spread, turn).otherwise(F.lit(0)))


def salted_copies(df: DataFrame, spread: Column, salts: int = SALTS) -> DataFrame:
    """A copy of each row for every salt where ``spread`` holds, one row elsewhere."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn(SALT, F.explode(F.when(spread, every).otherwise(F.array(F.lit(0)))))


def inner_join_x_y(
    x: DataFrame,
    y: DataFrame,
    key: str,
    null_safe: bool = False,
    hot_share: float | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Inner equi-join of features and labels; repeated keys fan out.

    ``null_safe`` also joins missing keys to missing keys. The join itself is left to the
    optimizer, which splits skewed partitions while it runs. ``hot_share`` adds an explicit
    split: rows of keys that hold this share of either side, and null-safe rows without a key,
    are spread over ``salts`` partitions and their partner rows are repeated for each of them.
    Use it when keys are not unique.
    """
    require_columns(x, [key], "join_key of X")
    require_columns(y, [key], "join_key of Y")
    x, y = _suffixed(x, y, [key])
    salted = []
    if hot_share is not None:
        hot_x = hot_keys(x, key, hot_share)
        hot_y = [k for k in hot_keys(y, key, hot_share) if k not in hot_x]
        in_x, in_y = _one_of(key, hot_x), _one_of(key, hot_y)
        if null_safe:
            in_x = in_x | quoted(key).isNull()
        # keys hot in X are spread in X and repeated in Y, keys hot in Y alone the other way
        x = salted_copies(salted_rows(x, in_x, salts).withColumnRenamed(SALT, "_turn"), in_y, salts)
        y = salted_copies(salted_rows(y, in_y, salts).withColumnRenamed(SALT, "_turn"), in_x, salts)
        x, y = (d.withColumn(SALT, F.col(SALT) + F.col("_turn")).drop("_turn") for d in (x, y))
        salted = [SALT]
    if null_safe:
        right = y.withColumnRenamed(key, "_key_y")
        on = quoted(key).eqNullSafe(F.col("_key_y"))
        for s in salted:
            right = right.withColumnRenamed(s, "_salt_y")
            on = on & (F.col(s) == F.col("_salt_y"))
        joined = x.join(right, on, "inner").drop("_key_y", "_salt_y")
    else:
        joined = x.join(y, [key, *salted], "inner")
    return joined.drop(*salted)


def _one_of(key: str, hot: list) -> Column:
    known = [k for k in hot if k is not None]
    return F.coalesce(quoted(key).isin(known), F.lit(False)) if known else F.lit(False)


def key_overlap(x: DataFrame, y: DataFrame, key: str) -> DataFrame:
    """One row of key facts about two tables, from one shuffle of keys and no join.

    Keys are counted per side before the exchange, so a hot key leaves each partition as
    one row. A missing key counts as a key value.
    """
    require_columns(x, [key], "join_key of X")
    require_columns(y, [key], "join_key of Y")
    k = quoted(key).alias("key")
    tagged = x.select(k, F.lit(1).alias("in_x"), F.lit(0).alias("in_y")).unionByName(
        y.select(k, F.lit(0).alias("in_x"), F.lit(1).alias("in_y"))
    )
    per_key = tagged.groupBy("key").agg(F.sum("in_x").alias("nx"), F.sum("in_y").alias("ny"))
    nx, ny = F.col("nx"), F.col("ny")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per_key.agg(
        total(nx).alias("rows_x"),
        total(ny).alias("rows_y"),
        total(F.greatest(nx - 1, F.lit(0))).alias("duplicates_x"),
        total(F.greatest(ny - 1, F.lit(0))).alias("duplicates_y"),
        F.count_if((nx > 0) & (ny > 0)).alias("keys_matched"),
        F.count_if((nx > 0) & (ny == 0)).alias("keys_only_x"),
        F.count_if((nx == 0) & (ny > 0)).alias("keys_only_y"),
    )


def duplicate_key_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key; a missing key is a key value like any other."""
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(df, keys, "key")
    per_key = df.groupBy(*[quoted(c) for c in keys]).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def one_to_one_join(x: DataFrame, y: DataFrame, key: str) -> DataFrame:
    """Inner join that refuses repeated keys on either side."""
    facts = key_overlap(x, y, key).first()
    for side in ("x", "y"):
        if facts[f"duplicates_{side}"]:
            raise ValueError(
                f"join_key {key!r} repeats in {side.upper()}: "
                f"{facts[f'duplicates_{side}']} surplus rows"
            )
    return inner_join_x_y(x, y, key)


def row_parity(x: DataFrame, y: DataFrame, key: str) -> DataFrame:
    """Do both tables have the same number of rows, and which keys lack a partner."""
    return key_overlap(x, y, key).select(
        "rows_x",
        "rows_y",
        (F.col("rows_x") == F.col("rows_y")).alias("same_rows"),
        "keys_matched",
        "keys_only_x",
        "keys_only_y",
    )


def column_legend(
    df: DataFrame,
    descriptions: Mapping[str, Mapping[str, str]],
    languages: Sequence[str] = ("en",),
    missing: Mapping[str, str] | None = None,
) -> DataFrame:
    """Each column of the frame with its description and the number of values it holds."""
    missing = MISSING_DESCRIPTION | dict(missing or {})
    one = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    if not df.columns:
        return report_frame(df.sparkSession, [], "column string, ordinal int, n long")
    return long_report(
        one,
        [
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                **{
                    lang: F.lit(descriptions.get(c, {}).get(lang, missing.get(lang, "")))
                    for lang in languages
                },
                "n": F.col(f"n{i}"),
            }
            for i, c in enumerate(df.columns)
        ],
    )
