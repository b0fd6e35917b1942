"""Exact order statistics and quantiles without sorting or collecting a column.

A column of any length is narrowed to the neighbourhood of the wanted rank: a
quantile sketch proposes two data values around the rank, every value is put into its
bucket among the proposals of its column and the buckets are counted, and the interval
shrinks to the part that holds the rank. Every proposal is checked by exact counts, so a sketch can only cost
another round, never a wrong value. When at most ``bound`` rows are left inside the
open interval, those rows are gathered and the value is read off. Nothing else is
shuffled but counts; a value held by a third of all rows ends the search as soon as a proposal hits it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlens.functions.columns import quoted

GATHER_BOUND = 10_000  # values of one column that may be gathered and sorted in a task
VALUES_PER_JOB = 1_000_000  # values of all columns gathered by one job
SKETCH_ACCURACY = 10_000
TARGETS_PER_JOB = 128
LISTED_CUTS = 16  # cuts of a column that are stated as comparisons; more are searched by a Bucketizer


@dataclass
class _Search:
    name: str
    rank: int
    inside: int
    below: int = 0
    low: Any = None
    high: Any = None
    found: bool = False
    value: Any = None

    @property
    def interval(self) -> tuple:
        return self.name, self.low, self.high

    def holds(self, column: Column) -> Column:
        cond = column.isNotNull()
        if self.low is not None:
            cond = cond & (column > F.lit(self.low))
        if self.high is not None:
            cond = cond & (column < F.lit(self.high))
        return cond


def non_missing_counts(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, int]:
    names = list(columns)
    row = df.agg(*[F.count(columns[n]).alias(f"n{i}") for i, n in enumerate(names)]).first()
    return {n: row[i] for i, n in enumerate(names)}


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Mapping[str, Sequence[int]],
    counts: Mapping[str, int] | None = None,
    bound: int = GATHER_BOUND,
) -> dict[tuple[str, int], Any]:
    """Values at the given 0-based ranks of each column's non-missing values, ascending."""
    if counts is None:
        counts = non_missing_counts(df, columns)
    searches = [
        _Search(name, rank, counts[name])
        for name, wanted in ranks.items()
        for rank in sorted(set(wanted))
    ]
    for s in searches:
        if not 0 <= s.rank < s.inside:
            raise ValueError(f"rank {s.rank} outside the {s.inside} values of {s.name}")
    while True:
        wide = [s for s in searches if not s.found and s.inside > bound]
        if not wide:
            break
        before = {id(s): (s.interval, s.found) for s in wide}
        for start in range(0, len(wide), TARGETS_PER_JOB):
            batch = [s for s in wide[start : start + TARGETS_PER_JOB] if not s.found]
            if batch:
                _narrow(df, columns, batch, searches)
        for s in wide:
            if before[id(s)] == (s.interval, s.found):
                _count_values(df, columns[s.name], s)
    _gather(df, columns, [s for s in searches if not s.found])
    return {(s.name, s.rank): s.value for s in searches}


def _narrow(
    df: DataFrame, columns: Mapping[str, Column], batch: list[_Search], searches: list[_Search]
) -> None:
    """Propose cuts for a batch, count around them once, and shrink every search they touch."""
    proposed = _proposals(df, columns, batch)
    ranges = _rank_ranges(df, columns, proposed)
    for s in searches:
        for v, less, less_or_equal in ranges.get(s.name, ()):
            _cut(s, v, less, less_or_equal)


def _proposals(
    df: DataFrame, columns: Mapping[str, Column], batch: list[_Search]
) -> dict[str, list]:
    """Data values around the wanted ranks, ascending per column, from one sketch an interval."""
    slack = 2.0 / SKETCH_ACCURACY
    intervals: dict[tuple, list[_Search]] = {}
    for s in batch:
        intervals.setdefault(s.interval, []).append(s)
    names, sketches = [], []
    for members in intervals.values():
        shares: set[float] = set()
        for s in members:
            at = (s.rank - s.below) / s.inside
            shares |= {max(0.0, at - slack), min(1.0, at + slack)}
        c = columns[members[0].name]
        names.append(members[0].name)
        kept = F.when(members[0].holds(c), c)
        sketches.append(F.percentile_approx(kept, sorted(shares), SKETCH_ACCURACY))
    row = df.agg(*[k.alias(f"s{i}") for i, k in enumerate(sketches)]).first()
    found: dict[str, set] = {}
    for i, name in enumerate(names):
        found.setdefault(name, set()).update(row[i])
    return {name: _ascending(values) for name, values in found.items()}


def _ascending(values: set) -> list:
    """Sorted, with NaN, the greatest number to Spark, last and once."""
    numbers = sorted(v for v in values if v == v)
    return numbers + [v for v in values if v != v][:1]


def _place(c: Column, cuts: Sequence, low: int, high: int) -> Column:
    """Bucket of a value among ascending cuts by halving: 2i lies below cut i, 2i + 1 on it."""
    if low == high:
        return F.lit(2 * low)
    mid = (low + high) // 2
    cut = F.lit(cuts[mid])
    on_or_above = F.when(c == cut, F.lit(2 * mid + 1)).otherwise(_place(c, cuts, mid + 1, high))
    return F.when(c < cut, _place(c, cuts, low, mid)).otherwise(on_or_above)


def _splits(cuts: Sequence) -> list[float] | None:
    """Splits whose buckets are those of ``_place``: a cut and the next number enclose the cut alone."""
    if len(cuts) <= LISTED_CUTS:
        return None
    own = [float(v) + 0.0 for v in cuts]
    out = [-math.inf, *[x for v in own for x in (v, float(np.nextafter(v, math.inf)))], math.inf]
    return out if all(a < b for a, b in zip(out, out[1:])) else None


def _bucketed(
    df: DataFrame, columns: Mapping[str, Column], cuts: Mapping[str, Sequence], with_value: bool
) -> tuple[DataFrame, int]:
    """(code[, v]) of every value that is not missing; code is column place times width plus bucket."""
    width = 2 * max(len(c) for c in cuts.values()) + 1
    values = df.select(*[columns[name].alias(f"c{i}") for i, name in enumerate(cuts)])
    kinds = [field.dataType for field in values.schema]
    splits = {i: s for i, at in enumerate(cuts.values()) if kinds[i] == T.DoubleType() and (s := _splits(at))}
    if splits:
        # a Bucketizer tells -0.0 from 0.0
        values = values.withColumns({f"z{i}": F.col(f"c{i}") + F.lit(0.0) for i in splits})
        named = [[f"{x}{i}" for i in splits] for x in "zb"]
        values = Bucketizer(splitsArray=list(splits.values()), inputCols=named[0], outputCols=named[1], handleInvalid="keep").transform(values)
    each = []
    for i, at in enumerate(cuts.values()):
        c = F.col(f"c{i}")
        # NaN lies above all cuts, and in a bucket of its own before
        place = F.least(F.col(f"b{i}").cast("int"), F.lit(2 * len(at))) if i in splits else _place(c, at, 0, len(at))
        code = F.when(c.isNotNull(), F.lit(i * width) + place).alias("code")
        each.append(F.struct(code, c.alias("v")) if with_value else F.struct(code))
    return values.select(F.inline(F.array(*each))).filter("code is not null"), width


def _rank_ranges(
    df: DataFrame, columns: Mapping[str, Column], cuts: Mapping[str, Sequence]
) -> dict[str, list[tuple[Any, int, int]]]:
    """Per column and cut the values below it and those up to it, from one count of buckets."""
    coded, width = _bucketed(df, columns, cuts, with_value=False)
    seen = {r["code"]: r["count"] for r in coded.groupBy("code").count().collect()}
    ranges: dict[str, list[tuple[Any, int, int]]] = {}
    for i, (name, at) in enumerate(cuts.items()):
        below = 0
        for j, v in enumerate(at):
            below += seen.get(i * width + 2 * j, 0)
            on = seen.get(i * width + 2 * j + 1, 0)
            ranges.setdefault(name, []).append((v, below, below + on))
            below += on
    return ranges


def _count_values(df: DataFrame, column: Column, s: _Search) -> None:
    """Settle a search whose interval the sketch cannot divide.

    Sketches work on doubles, so integers beyond 2**53 that share a double look alike; such
    values are ranked as they are.
    """
    inside = df.filter(s.holds(column))
    s.found, s.value = True, value_at_rank(inside, column, s.rank - s.below)


def _cut(s: _Search, v: Any, less: int, less_or_equal: int) -> None:
    """Shrink one search with a data value and its exact rank range."""
    if s.found or (s.low is not None and v <= s.low) or (s.high is not None and v >= s.high):
        return
    above = s.below + s.inside
    if s.rank < less:
        s.high, s.inside = v, less - s.below
    elif s.rank < less_or_equal:
        s.found, s.value = True, v
    else:
        s.low, s.below, s.inside = v, less_or_equal, above - less_or_equal


def _gather(df: DataFrame, columns: Mapping[str, Column], searches: list[_Search]) -> None:
    intervals: dict[tuple, list[_Search]] = {}
    for s in searches:
        intervals.setdefault(s.interval, []).append(s)
    batch: list[list[_Search]] = []
    held = 0
    for members in intervals.values():
        if batch and held + members[0].inside > VALUES_PER_JOB:
            _read_off(df, columns, batch)
            batch, held = [], 0
        batch.append(members)
        held += members[0].inside
    if batch:
        _read_off(df, columns, batch)


def _read_off(
    df: DataFrame, columns: Mapping[str, Column], batch: list[list[_Search]]
) -> None:
    """Gather open intervals and read the wanted values; columns of one type make one job.

    Every cut has been tried on every search of its column, so two intervals of a column are the
    same or lie apart, and each is one bucket between the ends of all.
    """
    kinds = df.select(*[columns[m[0].name].alias(f"c{i}") for i, m in enumerate(batch)]).schema
    by_kind: dict[str, list[list[_Search]]] = {}
    for members, field in zip(batch, kinds):
        by_kind.setdefault(field.dataType.simpleString(), []).append(members)
    for groups in by_kind.values():
        ends: dict[str, set] = {}
        for members in groups:
            known = ends.setdefault(members[0].name, set())
            known.update(v for v in (members[0].low, members[0].high) if v is not None)
        cuts = {name: _ascending(values) for name, values in ends.items()}
        coded, width = _bucketed(df, columns, cuts, with_value=True)
        held: dict[int, list[_Search]] = {}
        for members in groups:
            s, at = members[0], cuts[members[0].name]
            bucket = len(at) if s.high is None else _index(at, s.high)
            held[list(cuts).index(s.name) * width + 2 * bucket] = members
        wanted = F.create_map(
            *[
                x
                for code, members in held.items()
                for x in (F.lit(code), F.array(*[F.lit(s.rank - s.below) for s in members]))
            ]
        )
        kept = coded.filter(F.col("code").isin(list(held))).groupBy("code")
        ordered = kept.agg(F.sort_array(F.collect_list("v")).alias("kept"))
        picks = F.transform(wanted[F.col("code")], lambda i: F.get("kept", i))
        for row in ordered.select("code", picks.alias("picks")).collect():
            for s, v in zip(held[row["code"]], row["picks"]):
                s.found, s.value = True, v


def _index(cuts: Sequence, v: Any) -> int:
    return next(i for i, c in enumerate(cuts) if c == v or (c != c and v != v))


def quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probs: Sequence[float],
    counts: Mapping[str, int] | None = None,
    bound: int = GATHER_BOUND,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation; ``None`` for a column without values."""
    if not isinstance(columns, Mapping):
        columns = {c: quoted(c) for c in columns}
    columns = {n: c.cast("double") for n, c in columns.items()}
    if not columns:
        return {}
    if counts is None:
        counts = non_missing_counts(df, columns)
    ranks = {
        n: [r for p in probs for r in _neighbours(counts[n], p)[:2]]
        for n in columns
        if counts[n] > 0
    }
    values = order_statistics(df, {n: columns[n] for n in ranks}, ranks, counts, bound)
    out: dict[str, list[float | None]] = {}
    for n in columns:
        if n not in ranks:
            out[n] = [None] * len(probs)
            continue
        out[n] = []
        for p in probs:
            left, right, share = _neighbours(counts[n], p)
            a, b = values[n, left], values[n, right]
            out[n].append(a if a == b else a + (b - a) * share)
    return out


def _neighbours(n: int, p: float) -> tuple[int, int, float]:
    position = (n - 1) * p
    left = math.floor(position)
    return left, min(left + 1, n - 1), position - left


def smallest_rows(df: DataFrame, n: int, key: str | Column) -> DataFrame:
    """The ``n`` rows with the smallest key, missing keys first; all rows if there are fewer.

    The n-th smallest key is searched and the rows are kept by a plain filter, whatever ``n``;
    rows that share that key are chosen by row hash. Numbers, dates and times are narrowed down
    without an exchange, keys of other types are counted and ordered.
    """
    k = quoted(key) if isinstance(key, str) else key
    total, keyed = df.agg(F.count("*"), F.count(k)).first()
    if n >= total:
        return df
    missing = total - keyed
    if n <= missing:
        return _some_of(df.filter(k.isNull()), n)
    number = _as_number(df, k)
    if number is None:
        cut = value_at_rank(df, k, n - missing - 1)
    else:
        k, rank = number, n - missing - 1
        cut = order_statistics(df, {"k": k}, {"k": [rank]}, {"k": keyed})["k", rank]
    under = df.filter(k.isNull() | (k < F.lit(cut)))
    return under.unionByName(_some_of(df.filter(k == F.lit(cut)), n - under.count()))


def _as_number(df: DataFrame, key: Column) -> Column | None:
    """Numbers in the order of the key; ``None`` where its type has none."""
    kind = df.select(key.alias("k")).schema["k"].dataType
    if isinstance(kind, T.NumericType):
        return key
    if isinstance(kind, T.DateType):
        return F.unix_date(key)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    return None


def value_at_rank(df: DataFrame, column: Column, rank: int) -> Any:
    """The value at a 0-based rank of a column of any type that has an order.

    Equal values are counted before the exchange and range-partitioned; counts of earlier
    ranges are added up, so values are compared as they are and never as doubles.
    """
    from sensorlens.operators.ranks import running_totals

    counted = df.select(column.alias("v")).filter("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    placed = running_totals(counted, "v", "n")
    holds = (F.col("before") <= F.lit(rank)) & (F.lit(rank) < F.col("before") + F.col("n"))
    return placed.filter(holds).select("v").first()[0]


def _some_of(ties: DataFrame, n: int) -> DataFrame:
    """``n`` of the rows that share the cut key, chosen by row hash.

    Rows that share the hash as well are copies of each other: they are counted instead of
    gathered, and as many copies as needed are written out again.
    """
    h = F.shiftrightunsigned(F.xxhash64(*[quoted(c) for c in ties.columns]), 12)
    if n <= 0:
        return ties.limit(0)
    cut = order_statistics(ties, {"h": h}, {"h": [n - 1]})["h", n - 1]
    under = ties.filter(h < F.lit(cut))
    copies = (
        ties.filter(h == F.lit(cut))
        .groupBy(*[quoted(c).alias(c) for c in ties.columns])
        .agg(F.count("*").alias("_copies"))
    )
    rest = n - under.count()
    repeated = copies.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.least("_copies", F.lit(rest))))
    )
    return under.unionByName(repeated.drop("_copies", "_copy").limit(rest))
