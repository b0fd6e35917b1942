"""Positions over distinct values and joins that bring them back, safe for hot values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted
from sensorlens.functions.frames import materialise
from sensorlens.operators.keys import SALT, SALTS, hot_keys, salted_copies, salted_rows

LOOKUP_BOUND = 200_000  # lookup rows that may be broadcast or ordered in one task
LOOKUP_BYTES = 64 << 20  # bytes of a lookup that may be broadcast
HOT_SHARE = 0.001  # a key with this share of the rows is hot: at most 1000 such keys


def running_totals(
    values: DataFrame, order_by: str, weight: str, bound: int = LOOKUP_BOUND
) -> DataFrame:
    """Add ``before``: the summed weight of all rows with a smaller ``order_by`` value.

    ``order_by`` must be unique. Up to ``bound`` rows one window does it. Beyond that the
    rows are range-partitioned and written down, each partition is summed on its own, and
    only the partition totals (one row each) meet in one task.
    """
    kept = materialise(values)
    total = kept.count()
    if total <= bound:
        w = W.orderBy(order_by).rowsBetween(W.unboundedPreceding, -1)
        return kept.withColumn("before", F.coalesce(F.sum(weight).over(w), F.lit(0)))
    parts = -(-total // bound)
    placed = materialise(
        kept.repartitionByRange(parts, order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_sum"))
    across = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_offset")
    )
    within = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_inner", F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .join(offsets, "_part")
        .withColumn("before", F.col("_inner") + F.col("_offset"))
        .drop("_at", "_part", "_inner", "_offset")
    )


def small_enough(lookup: DataFrame, bound: int = LOOKUP_BOUND) -> bool:
    """Whether a written lookup has few enough rows and bytes to be sent to every task."""
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, total = lookup.agg(F.count("*"), F.sum(width)).first()
    return rows <= bound and (total or 0) <= LOOKUP_BYTES


def attach_by_key(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    bound: int = LOOKUP_BOUND,
    written: bool = False,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Left join with a lookup that has one row per key.

    A lookup of bounded rows and bytes is broadcast; to be measured it is written down first,
    unless it already rests on a ``written`` table. A larger one is joined by one exchange:
    rows whose key is hot in ``df`` (or in ``keys_of``, which holds the same keys at less cost)
    or missing are spread over salts, and the lookup rows of hot keys are repeated per salt.
    Hot keys are named by a sketch and limited in number by their share.
    """
    if not written:
        lookup = materialise(lookup)
    if small_enough(lookup, bound):
        return df.join(F.broadcast(lookup), key, "left")
    hot = hot_keys(df if keys_of is None else keys_of, key, HOT_SHARE)
    is_hot = F.coalesce(quoted(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    salted = salted_rows(df, is_hot | quoted(key).isNull(), SALTS)
    return salted.join(salted_copies(lookup, is_hot, SALTS), [key, SALT], "left").drop(SALT)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-missing value; equal values are merged before the exchange."""
    return (
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column).alias(column))
        .agg(F.count("*").alias("n"))
    )


def average_ranks(df: DataFrame, column: str, bound: int = LOOKUP_BOUND) -> DataFrame:
    """Average 1-based rank of each distinct value (ties share the middle of their range)."""
    placed = running_totals(value_counts(df, column), column, "n", bound)
    return placed.select(
        column, "n", (F.col("before") + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank")
    )


def replace_by_ranks(df: DataFrame, columns: Sequence[str], bound: int = LOOKUP_BOUND) -> DataFrame:
    """Replace columns by their average ranks; all ranks are counted on ``df`` itself.

    Each column adds one join to the plan, whatever the size of its lookup.
    """
    base = materialise(df)
    out = base
    for c in columns:
        ranks = materialise(average_ranks(base, c, bound).drop("n").withColumnRenamed("avg_rank", "_rank"))
        joined = attach_by_key(out, ranks, c, bound, written=True, keys_of=base.select(quoted(c)))
        out = joined.withColumn(c, F.col("_rank")).drop("_rank")
    return out
