"""Repeatable splits. Membership depends on the key alone, never on row order."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import (
    hex_threshold,
    quoted,
    require_columns,
    split_digest,
    split_number,
)
from sensorlens.functions.frames import materialise
from sensorlens.operators.order_stats import non_missing_counts, order_statistics
from sensorlens.operators.ranks import attach_by_key, running_totals

LISTED_CLASSES = 1_000  # classes whose cuts are stated in a filter; more are joined
RANGES = 4096  # ranges of the key digest, for cuts found by counting


@dataclass(frozen=True)
class HoldoutConfig:
    test_size: float = 0.2
    random_state: int = 42
    stratify: bool = True
    exact: bool = True
    key: str = "id"


# A threshold on the key digest and nothing else: no pass over the rows, shares on average.
BY_THRESHOLD = HoldoutConfig(stratify=False, exact=False)


def largest_remainder(counts: dict, total: int) -> dict:
    """Share ``total`` among classes in proportion to ``counts``, whole rows only."""
    everything = sum(counts.values())
    exact = {c: total * n / everything for c, n in counts.items()}
    out = {c: int(v) for c, v in exact.items()}
    by_rest = sorted(counts, key=lambda c: (-(exact[c] - out[c]), str(c)))
    for c in by_rest[: total - sum(out.values())]:
        out[c] += 1
    return out


def class_counts(df: DataFrame, label: str) -> dict | None:
    """Rows per class, or ``None`` for more than ``LISTED_CLASSES``."""
    rows = df.groupBy(quoted(label).alias("label")).count().limit(LISTED_CLASSES + 1).collect()
    return {r["label"]: r["count"] for r in rows} if len(rows) <= LISTED_CLASSES else None


def holdout_flag(df: DataFrame, label: str | None, cfg: HoldoutConfig) -> Column | None:
    """Boolean column that is true on the test side; ``None`` for too many classes to list.

    Each class gets its exact number of test rows: the wanted rank of the key digest within
    the class is searched by counting passes, and the split is a plain filter. Without
    ``stratify`` or a label all rows are one class. ``exact=False`` takes a row whose digest
    falls under a threshold: no count at all, and shares that hold on average. Rows that share
    a key stay together in either way.
    """
    require_columns(df, [cfg.key], "key")
    if not 0 < cfg.test_size < 1:
        raise ValueError(f"test_size must lie strictly between 0 and 1, got {cfg.test_size}")
    if not cfg.exact:
        digest = split_digest(quoted(cfg.key), cfg.random_state)
        return F.substring(digest, 1, 8) < F.lit(hex_threshold(cfg.test_size))
    number = split_number(quoted(cfg.key), cfg.random_state)
    if cfg.stratify and label is not None:
        require_columns(df, [label], "label")
        counts = class_counts(df, label)
        if counts is None:
            return None
        member = {c: quoted(label).eqNullSafe(F.lit(c)) for c in counts}
    else:
        counts = non_missing_counts(df, {None: number})
        member = {None: F.lit(True)}
    total = sum(counts.values())
    if not total:
        return F.lit(False)
    n_test = math.ceil(round(total * cfg.test_size, 9))
    train = largest_remainder(counts, total - n_test)
    wanted = {c: counts[c] - train[c] for c in counts if counts[c] > train[c]}
    columns = {c: F.when(member[c], number) for c in wanted}
    cuts = order_statistics(
        df, columns, {c: [k - 1] for c, k in wanted.items()}, {c: counts[c] for c in wanted}
    )
    flag = F.lit(False)
    for c, k in wanted.items():
        flag = flag | (member[c] & (number <= F.lit(cuts[c, k - 1])))
    return flag


def class_cuts(df: DataFrame, label: str, cfg: HoldoutConfig) -> DataFrame:
    """(_class, _cut, _n): the largest test digest of each class, for any number of classes.

    Shares are rounded by largest remainder as for listed classes. A class's cut is found by
    counting its digests per range, then by ordering the digests of the one range that holds it.
    """
    number = split_number(quoted(cfg.key), cfg.random_state)
    rows = df.select(_class_name(label).alias("_class"), number.alias("_number"))
    width = (1 << 52) // RANGES
    ranges = rows.groupBy("_class", F.expr(f"_number div {width}").alias("_range")).agg(F.count("*").alias("_rows"))
    ranges = materialise(ranges)
    classes = ranges.groupBy("_class").agg(F.sum("_rows").alias("_n"))
    total = ranges.agg(F.sum("_rows")).first()[0]
    n_train = total - math.ceil(round(total * cfg.test_size, 9))
    exact = F.col("_n") * F.lit(float(n_train)) / F.lit(float(total))
    shares = materialise(classes.withColumn("_whole", F.floor(exact)).withColumn("_rest", F.floor(exact) - exact))
    left = n_train - shares.agg(F.sum("_whole")).first()[0]
    turns = running_totals(
        shares.withColumns({"_turn": F.struct("_rest", "_class"), "_one": F.lit(1)}), "_turn", "_one"
    )
    wanted = turns.select(
        "_class", "_n", (F.col("_n") - F.col("_whole") - (F.col("before") < left).cast("int")).alias("_test")
    )
    below = W.partitionBy("_class").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    placed = ranges.withColumn("_below", F.coalesce(F.sum("_rows").over(below), F.lit(0))).join(wanted, "_class")
    holds = (F.col("_below") < F.col("_test")) & (F.col("_test") <= F.col("_below") + F.col("_rows"))
    chosen = placed.filter(holds)
    inside = rows.withColumn("_range", F.expr(f"_number div {width}")).join(chosen, ["_class", "_range"])
    order = W.partitionBy("_class").orderBy("_number")
    return (
        inside.withColumn("_at", F.row_number().over(order) + F.col("_below"))
        .filter("_at = _test")
        .select("_class", F.col("_number").alias("_cut"), "_n")
    )


def _class_name(label: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), quoted(label).cast("string")), F.lit("missing"))


def holdout_side(df: DataFrame, label: str | None, cfg: HoldoutConfig = HoldoutConfig()):
    """The rows with ``is_test``."""
    flag = holdout_flag(df, label, cfg)
    if flag is not None:
        return df.withColumn("is_test", flag)
    named = df.withColumn("_class", _class_name(label))
    joined = attach_by_key(named, class_cuts(df, label, cfg), "_class")
    number = split_number(quoted(cfg.key), cfg.random_state)
    is_test = F.coalesce(number <= F.col("_cut"), F.lit(False))
    return joined.withColumn("is_test", is_test).drop("_class", "_cut", "_n")


def split_holdout(
    df: DataFrame, label: str | None, cfg: HoldoutConfig = HoldoutConfig()
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test frames that together hold every row."""
    if label is not None:
        require_columns(df, [label], "label")
    flag = holdout_flag(df, label, cfg)
    if flag is not None:
        return df.filter(~flag), df.filter(flag)
    sides = materialise(holdout_side(df, label, cfg))
    return sides.filter("not is_test").drop("is_test"), sides.filter("is_test").drop("is_test")


def train_val_test(
    df: DataFrame,
    val: float = 0.1,
    test: float = 0.2,
    random_state: int = 42,
    key: str = "id",
    label: str | None = None,
) -> DataFrame:
    """Add ``part`` (train, val or test): adjacent bands of the key digest.

    With a label every class gives its exact share to each part, as in the hold-out: the test
    rows have the smallest digests of their class, the validation rows the next ones.
    """
    if not 0 < val + test < 1:
        raise ValueError("val + test must lie strictly between 0 and 1")
    require_columns(df, [key], "key")
    if label is None:
        digest = F.substring(split_digest(quoted(key), random_state), 1, 8)
        part = (
            F.when(digest < F.lit(hex_threshold(test)), F.lit("test"))
            .when(digest < F.lit(hex_threshold(test + val)), F.lit("val"))
            .otherwise(F.lit("train"))
        )
        return df.withColumn("part", part)
    tested = holdout_side(df, label, HoldoutConfig(test, random_state, key=key))
    both = holdout_side(
        tested.withColumnRenamed("is_test", "_tested"), label, HoldoutConfig(test + val, random_state, key=key)
    )
    part = F.when(F.col("_tested"), "test").when(F.col("is_test"), "val").otherwise("train")
    return both.withColumn("part", part).drop("_tested", "is_test")


def fold_column(df: DataFrame, folds: int = 5, random_state: int = 42, key: str = "id") -> DataFrame:
    """Add ``fold`` in 0..folds-1 from the key digest, for cross-validation."""
    require_columns(df, [key], "key")
    number = split_number(quoted(key), random_state)
    return df.withColumn("fold", F.pmod(number, F.lit(folds)).cast("int"))


def micros(df: DataFrame, time_col: str) -> Column:
    """Time as whole microseconds, whatever the time type."""
    kind = df.schema[time_col].dataType.typeName()
    t = quoted(time_col)
    if kind == "timestamp_ntz":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, t)
    if kind == "timestamp":
        return F.unix_micros(t)
    if kind == "date":
        return F.unix_date(t).cast("long") * F.lit(86_400_000_000)
    return t.cast("long")


def _time_cuts(df: DataFrame, time_col: str, blocks: list[float]) -> list[Column]:
    """Times at the given shares, as literals of the column's type: scans can skip by them."""
    t = micros(df, time_col)
    n = non_missing_counts(df, {"t": t})["t"]
    ranks = [min(n - 1, int(n * share)) for share in blocks]
    found = order_statistics(df, {"t": t}, {"t": ranks}, {"t": n})
    return [_time_literal(df, time_col, found["t", r]) for r in ranks]


def _time_literal(df: DataFrame, time_col: str, value: int) -> Column:
    kind = df.schema[time_col].dataType.typeName()
    epoch = datetime(1970, 1, 1)
    if kind == "timestamp_ntz":
        return F.lit((epoch + timedelta(microseconds=value)).isoformat(" ")).cast("timestamp_ntz")
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(value))
    if kind == "date":
        return F.lit((epoch + timedelta(microseconds=value)).date())
    return F.lit(value).cast(df.schema[time_col].dataType)


def temporal_split(df: DataFrame, time_col: str, test_size: float = 0.2) -> DataFrame:
    """Add ``is_test``: the latest ``test_size`` of the rows; equal times stay together."""
    (cut,) = _time_cuts(df, time_col, [1 - test_size])
    return df.withColumn("is_test", quoted(time_col) >= cut)


def walk_forward(df: DataFrame, time_col: str, n_splits: int = 5) -> DataFrame:
    """Add ``block`` in 0..n_splits: time-ordered blocks of equal size.

    Fold k (from 1) trains on blocks before k and tests on block k.
    """
    block = F.lit(0)
    for cut in _walk_cuts(df, time_col, n_splits):
        block = block + (quoted(time_col) >= cut).cast("int")
    return df.withColumn("block", block)


def _walk_cuts(df: DataFrame, time_col: str, n_splits: int) -> list[Column]:
    return _time_cuts(df, time_col, [k / (n_splits + 1) for k in range(1, n_splits + 1)])


def walk_forward_folds(df: DataFrame, time_col: str, n_splits: int = 5):
    """The (train, test) pairs of :func:`walk_forward`; each is a plain range of times.

    Rows without a time lie in no fold.
    """
    cuts = _walk_cuts(df, time_col, n_splits)
    t = quoted(time_col)
    return [
        (df.filter(t < cut), df.filter(t >= cut) if k == n_splits else df.filter((t >= cut) & (t < cuts[k])))
        for k, cut in enumerate(cuts, start=1)
    ]
