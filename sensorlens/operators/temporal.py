"""Rows in time: as-of joins and rolling windows that split hot keys over tasks.

Neither gives a key to one task. The as-of join deals both sides into ranges of (key, time); what a range
needs from earlier ranges is the last row of its first key, a table of one row per range. Rolling
windows cut time into blocks of one width and put each window together from running aggregates of two blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DayTimeIntervalType, DecimalType, YearMonthIntervalType

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import materialise

ROLLING: Mapping[str, object] = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str | None = None,
    columns: Sequence[str] | None = None,
    allow_equal: bool = True,
    tolerance: str | None = None,
    prefix: str = "asof_",
    how: str = "left",
) -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right`` of its key at or before its time.

    ``allow_equal=False`` asks for strictly earlier rows; ``tolerance`` (an interval such as ``1 hour``) for rows no
    older than that. Of right rows with one key and time the one with the largest columns counts, in their order. Left rows with a missing key or
    time, or without an earlier row, have nulls, or go with ``how="inner"``; right rows without key or time are never met.
    """
    right_time = right_time or left_time
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, got {how}")
    require_columns(left, [key, left_time], "left")
    columns = [c for c in right.columns if c not in (key,)] if columns is None else list(columns)
    require_columns(right, [key, right_time, *columns], "right")
    taken = [quoted(right_time).alias("t"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(columns)]]
    there = right.filter(quoted(key).isNotNull() & quoted(right_time).isNotNull())
    there = there.select(quoted(key).alias("_k"), quoted(right_time).alias("_t"), F.struct(*taken).alias("_held"))
    there = there.groupBy("_k", "_t").agg(F.max("_held").alias("_held"))
    own = F.struct(*[quoted(c) for c in left.columns])
    here = left.select(quoted(key).alias("_k"), quoted(left_time).alias("_t"), own.alias("_row"))
    # at one time, right rows come first where they count and last where they do not
    both = here.withColumns({"_side": F.lit(1), "_held": F.lit(None).cast(there.schema["_held"].dataType)}).unionByName(
        there.withColumns({"_side": F.lit(0 if allow_equal else 2), "_row": F.lit(None).cast(here.schema["_row"].dataType)})
    )
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = both.repartitionByRange(n, "_k", "_t", "_side").withColumn("_part", F.spark_partition_id())
    ranged = materialise(ranged)

    inside = W.partitionBy("_part", "_k").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0)
    last = ranged.withColumn("_last", F.last("_held", ignorenulls=True).over(inside)).filter("_side = 1")

    ends = ranged.groupBy("_k", "_part").agg(F.max_by("_held", F.when(F.col("_held").isNotNull(), F.col("_t"))).alias("_end"))
    several = W.partitionBy("_k")
    earlier = W.partitionBy("_k").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.withColumn("_parts", F.count("*").over(several)).withColumn(
        "_before", F.last("_end", ignorenulls=True).over(earlier)
    )
    carried = materialise(carried.filter("_parts > 1 and _before is not null and _k is not null").select("_k", "_part", "_before"))
    # a range shares at most its first key with the range before it: no more rows than ranges
    found = last.join(F.broadcast(carried), ["_k", "_part"], "left").withColumn("_last", F.coalesce("_last", "_before"))
    near = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    if tolerance is not None:
        near = near & (F.col("_last.t") >= F.col("_t") - F.expr(f"interval {tolerance}"))
    found = found.withColumn("_last", F.when(near, F.col("_last")))
    if how == "inner":
        found = found.filter(F.col("_last").isNotNull())
    return found.select("_row.*", *[F.col(f"_last.c{i}").alias(prefix + c) for i, c in enumerate(columns)])


def rolling(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    width: str,
    features: Mapping[str, tuple[str, str]],
    closed: str = "both",
) -> DataFrame:
    """Add aggregates of each row's key over the ``width`` (such as ``1 hour``) up to the row's time.

    ``features`` maps a new column to (aggregate, column); aggregates are sum, mean, min, max and count. ``closed`` is
    ``both`` (a row exactly ``width`` ago counts) or ``right`` (it does not). Rows at the same time see each other.
    Rows without a time have nulls; rows without a key are a key of their own. Time is cut into blocks of one width, so a window is
    the end of one block and the start of the next: both are running aggregates, whose cost follows the rows and not the
    rows a window holds. One task holds the rows of one key within a width, and those of the next as marks of where their windows begin.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require_columns(df, [*keys, time, *[c for _, c in features.values()]])
    unknown = [a for a, _ in features.values() if a not in ROLLING]
    if unknown or closed not in ("both", "right"):
        raise ValueError(f"aggregates must be among {sorted(ROLLING)} and closed both or right, got {unknown}, {closed}")
    span = int(df.sparkSession.sql(f"select cast(unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {width}) as long)").first()[0])
    if span <= 0:
        raise ValueError(f"width must be positive, got {width}")
    if not features:
        return df
    at = F.unix_micros(quoted(time).cast("timestamp"))
    whole = df.select(*[ROLLING[a](quoted(c)).alias(name) for name, (a, c) in features.items()])
    types = {name: whole.schema[name].dataType for name in features}
    summed, rolled = _parts_of_windows(df, features, types)
    own = F.struct(*[quoted(c) for c in df.columns]).alias("_row")
    parts = [c.alias(f"_p{i}") for i, (_, c) in enumerate(summed)]
    timed = df.select(own, *[quoted(k) for k in keys], at.alias("_at"), *parts).filter("_at is not null")
    placed = timed.withColumn("_in", F.expr(f"(_at - pmod(_at, {span})) div {span}"))
    names = [f"_p{i}" for i in range(len(summed))]
    # a mark lies where the window of its row begins, a block earlier, among the rows of that block
    rows = placed.drop("_row").withColumns({"_side": F.lit(0), "_row": F.lit(None).cast(placed.schema["_row"].dataType)})
    marks = placed.withColumns({"_side": F.lit(1 if closed == "both" else -1), "_at": F.col("_at") - span, "_in": F.col("_in") - 1})
    group = [*[quoted(k) for k in keys], F.col("_in")]
    back = W.partitionBy(*group).orderBy(F.desc("_at"), "_side").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.unionByName(marks).withColumns(
        {f"_e{i}": agg(F.when(F.col("_side") == 0, F.col(n))).over(back) for i, ((agg, _), n) in enumerate(zip(summed, names))}
    )
    begun = ends.filter("_side <> 0").withColumns({"_at": F.col("_at") + span, "_in": F.col("_in") + 1})
    on = W.partitionBy(*group).orderBy("_at").rangeBetween(W.unboundedPreceding, 0)
    both = begun.withColumns({f"_s{i}": agg(F.col(n)).over(on) for i, ((agg, _), n) in enumerate(zip(summed, names))})
    result = both.select("_row.*", *[made.cast(types[name]).alias(name) for name, made in rolled.items()])
    untimed = df.filter(at.isNull()).withColumns({n: F.lit(None).cast(types[n]) for n in rolled})
    return result.unionByName(untimed)


def _parts_of_windows(df: DataFrame, features: Mapping[str, tuple[str, str]], types: Mapping[str, DataType]):
    """Running aggregates of columns, and every feature from the end ``_e`` and the start ``_s`` of each."""
    summed, rolled = [], {}

    def part(agg, column) -> int:
        summed.append((agg, column))
        return len(summed) - 1

    def added(i: int) -> Column:
        end, start = F.col(f"_e{i}"), F.col(f"_s{i}")
        return F.when(end.isNull(), start).when(start.isNull(), end).otherwise(end + start)

    for name, (aggregate, column) in features.items():
        value = quoted(column)
        if aggregate in ("min", "max"):
            i = part(ROLLING[aggregate], value)
            rolled[name] = (F.least if aggregate == "min" else F.greatest)(F.col(f"_e{i}"), F.col(f"_s{i}"))
        elif aggregate == "mean":
            exact = isinstance(types[name], (DecimalType, DayTimeIntervalType, YearMonthIntervalType))
            rolled[name] = added(part(F.sum, value if exact else value.cast("double"))) / F.nullif(added(part(F.count, value)), F.lit(0))
        else:
            rolled[name] = added(part(ROLLING[aggregate], value))
    return summed, rolled


def changes(df: DataFrame, key: str, time: str, columns: Sequence[str], prefix: str = "previous_") -> DataFrame:
    """Add the columns of the last strictly earlier row of the key: a shift by one that no hot key stops."""
    return as_of_join(df, df, key, time, columns=list(columns), allow_equal=False, prefix=prefix)
