"""Rules held in a table: values meet the intervals that hold them, through an index of bins.

Bins double in width from level to level. A rule lies on the level whose bins are as wide as the
rule is long, so it touches two bins at most; a value lies in one bin of every level that has
rules. Values and rules meet by an equi-join on level and bin, and the exact comparison decides. Rules
without a lower or an upper bound lie on a level of one bin. That bin, and those of very long rules, hold many values:
values are dealt over salts by content, and the rules, which are few, are repeated for each salt.

Open and long rules hold a share of all values each, so what is only counted per rule is not joined:
:func:`rule_counts` and :func:`rule_violations` place the bounds among the sorted values and read sums at them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import materialise
from sensorlens.operators.temporal import as_of_join

SALTS = 8
UNBOUNDED = 2_000  # the level of rules without one of their bounds, above that of any double


def _salted(value: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(salts)).cast("int")


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def _sensible(lo: Column, hi: Column) -> Column:
    return F.coalesce(lo <= hi, F.lit(True)) & ~F.coalesce(F.isnan(lo) | F.isnan(hi), F.lit(False))


def interval_index(rules: DataFrame, low: str, high: str, salts: int = SALTS) -> DataFrame:
    """The rules with ``_level``, ``_bin`` and ``_salt``; rules that hold nothing are left out."""
    require_columns(rules, [low, high], "rule")
    lo, hi = quoted(low).cast("double"), quoted(high).cast("double")
    bounded = lo.isNotNull() & hi.isNotNull() & (F.abs(lo) < float("inf")) & (F.abs(hi) < float("inf"))
    # bins no narrower than what doubles of that size can tell apart
    length = F.greatest(hi - lo, F.abs(lo) * F.lit(2.0**-40), F.abs(hi) * F.lit(2.0**-40), F.lit(2.0**-300))
    # a little wider than the rule, so that rounding never makes it touch a third bin
    level = F.when(bounded, F.ceil(F.log2(length * F.lit(1.000001))).cast("int")).otherwise(F.lit(UNBOUNDED))
    bins = F.when(bounded, F.array_distinct(F.array(_bin(lo, F.col("_level")), _bin(hi, F.col("_level"))))).otherwise(F.array(F.lit(0).cast("long")))
    placed = rules.filter(_sensible(lo, hi)).withColumn("_level", level).withColumn("_bin", F.explode(bins))
    return placed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def range_join(
    values: DataFrame,
    rules: DataFrame,
    column: str,
    low: str,
    high: str,
    by: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Every row of ``values`` with every rule whose ``low`` <= value <= ``high``, of the same ``by``.

    A bound that is missing does not bind. Rows without a value, and rules without one of the ``by`` columns, meet none.
    """
    require_columns(values, [column, *by])
    require_columns(rules, [*by], "rule")
    clash = [c for c in rules.columns if c in values.columns and c not in by]
    if clash:
        raise ValueError(f"columns of both sides: {clash}")
    value = quoted(column).cast("double")
    index = interval_index(rules, low, high, salts)
    levels = sorted(r["_level"] for r in index.select("_level").distinct().collect())
    places = F.array(
        *[
            F.struct(
                F.lit(at).cast("int").alias("_level"),
                (F.lit(0).cast("long") if at == UNBOUNDED else _bin(value, F.lit(float(at)))).alias("_bin"),
            )
            for at in levels
        ]
    ) if levels else F.array().cast("array<struct<_level:int,_bin:bigint>>")
    usable = values.filter(value.isNotNull() & ~F.isnan(value))
    dealt = usable.select("*", F.inline(places)).withColumn("_salt", _salted(value, salts))
    met = dealt.join(index, ["_level", "_bin", "_salt", *by])
    inside = (F.coalesce(quoted(low).cast("double") <= value, F.lit(True))) & (F.coalesce(value <= quoted(high).cast("double"), F.lit(True)))
    return met.filter(inside).drop("_level", "_bin", "_salt")


def _all_there(names: Sequence[str]) -> Column:
    there = F.lit(True)
    for c in names:
        there = there & quoted(c).isNotNull()
    return there


def _sums_at(points: DataFrame, probes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every probe with ``n``, the sum over the points of its keys below ``_at`` (``_side`` 0) or up to it (2), and ``highest`` of these.

    Points have the keys, ``_at`` and ``n``, probes the keys, ``_at``, ``_side`` and ``_probe``; no key is missing. Both are dealt
    into ranges of (keys, ``_at``), and a range needs the sums of earlier ones for its first keys only, a row each.
    """
    names = [quoted(c) for c in keys]
    carried_probe = probes.schema["_probe"].dataType
    both = points.select(*names, "_at", F.lit(1).alias("_side"), "n", F.lit(None).cast(carried_probe).alias("_probe")).unionByName(
        probes.select(*names, "_at", F.col("_side").cast("int").alias("_side"), F.lit(None).cast("long").alias("n"), "_probe")
    )
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(both.repartitionByRange(parts, *names, "_at", "_side").withColumn("_part", F.spark_partition_id()))
    own = F.when(F.col("_side") == 1, F.col("_at"))
    inside = W.partitionBy("_part", *names).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    met = ranged.withColumns({"_sum": F.sum("n").over(inside), "_high": F.max(own).over(inside)}).filter("_side <> 1")
    totals = ranged.groupBy(*names, "_part").agg(F.sum("n").alias("_s"), F.max(own).alias("_h"))
    several, earlier = W.partitionBy(*names), W.partitionBy(*names).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(
        *names, "_part", F.count("*").over(several).alias("_parts"), F.sum("_s").over(earlier).alias("_sum_before"), F.max("_h").over(earlier).alias("_high_before")
    )
    # keys that span ranges: at most two to a range
    before = materialise(before.filter("_parts > 1 and _sum_before is not null").drop("_parts"))
    return met.join(F.broadcast(before), [*keys, "_part"], "left").select(
        *names, "_at", "_side", "_probe",
        (F.coalesce("_sum", F.lit(0)) + F.coalesce("_sum_before", F.lit(0))).alias("n"),
        F.coalesce("_high", "_high_before").alias("highest"),
    )


def _ends(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both bounds of every interval as probes."""
    low, high = F.struct(F.col("_low").alias("_at"), F.lit(0).alias("_side")), F.struct(F.col("_high").alias("_at"), F.lit(2).alias("_side"))
    return intervals.select(*[quoted(c) for c in by], F.struct("_low", "_high").alias("_probe"), F.inline(F.array(low, high)))


def _held(points: DataFrame, intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per interval the sum of the points it holds, and the highest of these; intervals that hold none are left out."""
    signed = F.col("n") * (F.col("_side") - 1)
    return (
        _sums_at(points, _ends(intervals, by), by)
        .groupBy(*[quoted(c) for c in by], "_probe")
        .agg(F.sum(signed).alias("n"), F.max(F.when(F.col("_side") == 2, F.col("highest"))).alias("highest"))
        .filter("n > 0")
        .select(*[quoted(c) for c in by], "_probe._low", "_probe._high", "n", "highest")
    )


def _nested(pairs: DataFrame, intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per interval, how many pairs ``_from`` < ``_at`` lie in it whole.

    These are the pairs that end by its upper bound, less those of them that begin below its lower one. Pairs have a place in the
    order of beginnings; those before a place are a block of that order per binary digit of the place, and each block counts ends.
    """
    names = [quoted(c) for c in by]
    pairs = materialise(pairs)
    levels = max(1, pairs.count().bit_length())
    starts = pairs.groupBy(*names, F.col("_from").alias("_at")).agg(F.count("*").alias("n"))
    ends = pairs.groupBy(*names, "_at").agg(F.count("*").alias("n"))
    own = pairs.select(*names, F.col("_from").alias("_at"), F.lit(0).alias("_side"), F.struct("_at").alias("_probe"))
    placed = _sums_at(starts, own, by).select(*names, F.col("_probe._at").alias("_at"), F.col("n").alias("_place"))
    probes = intervals.select(*names, F.col("_low").alias("_at"), F.lit(0).alias("_side"), F.struct("_low", "_high").alias("_probe"))
    below = _sums_at(starts, probes, by).select(*names, "_probe", F.col("n").alias("_place"))
    digits = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")
    block = F.expr("shiftright(_place, _level)")
    points = placed.select("*", digits).groupBy(*names, "_level", block.alias("_block"), "_at").agg(F.count("*").alias("n"))
    asked = below.select("*", digits).filter(block % 2 == 1)
    asked = asked.select(*names, "_level", (block - 1).alias("_block"), F.col("_probe._high").alias("_at"), F.lit(2).alias("_side"), "_probe")
    early = _sums_at(points, asked, [*by, "_level", "_block"]).select(*names, "_probe", (-F.col("n")).alias("n"))
    until = intervals.select(*names, F.col("_high").alias("_at"), F.lit(2).alias("_side"), F.struct("_low", "_high").alias("_probe"))
    ended = _sums_at(ends, until, by).select(*names, "_probe", "n")
    found = ended.unionByName(early).groupBy(*names, "_probe").agg(F.sum("n").alias("_again"))
    return found.select(*names, "_probe._low", "_probe._high", "_again")


def _intervals(rules: DataFrame, rule: str, low: str, high: str, by: Sequence[str]) -> DataFrame:
    """Rules that can hold a value, equal ones once with ``_times``; a bound that is missing is infinite."""
    lo, hi = quoted(low).cast("double"), quoted(high).cast("double")
    there = rules.filter(_sensible(lo, hi) & _all_there(by))
    bounds = F.coalesce(lo, F.lit(float("-inf"))) + F.lit(0.0), F.coalesce(hi, F.lit(float("inf"))) + F.lit(0.0)
    return there.groupBy(quoted(rule), *[quoted(c) for c in by], bounds[0].alias("_low"), bounds[1].alias("_high")).agg(F.count("*").alias("_times"))


def _usable(values: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    value = quoted(column).cast("double")
    return values.filter(value.isNotNull() & ~F.isnan(value) & _all_there(by))


def rule_counts(
    values: DataFrame, rules: DataFrame, column: str, rule: str, low: str, high: str, by: Sequence[str], distinct: str
) -> DataFrame:
    """Per rule that holds a row: the rows ``n``, the ``n_distinct`` different ``distinct`` of these, and their ``highest`` value.

    The same as aggregates of :func:`range_join`, without its rows: those can be as many as rows times rules. Only rules of one
    name with several intervals are joined for their distinct count, since their intervals can share rows.
    """
    require_columns(values, [column, distinct, *by])
    require_columns(rules, [rule, low, high, *by], "rule")
    names, at = [quoted(c) for c in by], (quoted(column).cast("double") + F.lit(0.0)).alias("_at")
    kept = _usable(values, column, by)
    once = materialise(kept.groupBy(*names, quoted(distinct).alias("_id"), at).agg(F.count("*").alias("n"), F.count(quoted(distinct)).alias("_ids")))
    told = materialise(_intervals(rules, rule, low, high, by))
    asked = materialise(told.select(*names, "_low", "_high").distinct())
    spot = [*by, "_low", "_high"]
    counted = _held(once.groupBy(*names, "_at").agg(F.sum("n").alias("n")), asked, by)
    ids = once.filter("_id is not null")
    different = _held(ids.groupBy(*names, "_at").agg(F.count("*").alias("n")), asked, by).drop("highest").withColumnRenamed("n", "n_distinct")
    if not ids.groupBy(*names, "_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        # an id counts once for every value it has in the interval, less once for each two that follow each other in it
        keyed = ids.select(*names, "_at", F.struct(*names, "_id").alias("_key"))
        pairs = as_of_join(keyed, keyed.select("_key", "_at"), "_key", "_at", columns=["_at"], allow_equal=False, how="inner")
        again = _nested(pairs.select(*names, "_at", F.col("asof__at").alias("_from")), asked, by)
        different = different.join(again, spot, "left").withColumn("n_distinct", F.col("n_distinct") - F.coalesce("_again", F.lit(0))).drop("_again")
    found = told.join(counted.join(different, spot, "left"), spot)
    found = materialise(found.withColumn("_intervals", F.count("*").over(W.partitionBy(quoted(rule)))))
    n, n_distinct = F.col("n") * F.col("_times"), F.coalesce("n_distinct", F.lit(0))
    single = found.filter("_intervals = 1").select(quoted(rule), n.alias("n"), n_distinct.alias("n_distinct"), "highest")
    several = found.filter("_intervals > 1")
    if several.isEmpty():
        return single
    totals = several.groupBy(quoted(rule)).agg(F.sum(n).alias("n"), F.max("highest").alias("highest"))
    rows = kept.select(*names, quoted(distinct).alias("_id"), quoted(column).cast("double").alias("_value"))
    met = range_join(rows, several.select(quoted(rule).alias("_rule"), *names, "_low", "_high"), "_value", "_low", "_high", by)
    shared = met.groupBy("_rule").agg(F.count_distinct("_id").alias("n_distinct"))
    both = totals.join(shared, quoted(rule).eqNullSafe(F.col("_rule")))
    return single.unionByName(both.select(quoted(rule), "n", "n_distinct", "highest"))


def rule_violations(
    values: DataFrame, rules: DataFrame, column: str, rule: str, low: str, high: str, by: Sequence[str]
) -> DataFrame:
    """Per rule: the rows of its group that have a value, how many lie outside, and the share of these."""
    names, at = [quoted(c) for c in by], (quoted(column).cast("double") + F.lit(0.0)).alias("_at")
    points = materialise(_usable(values, column, by).groupBy(*names, at).agg(F.count("*").alias("n")))
    totals = points.groupBy(*names).agg(F.sum("n").alias("n"))
    told = materialise(_intervals(rules, rule, low, high, by))
    held = _held(points, told.select(*names, "_low", "_high").distinct(), by)
    inside = told.join(held, [*by, "_low", "_high"]).select(quoted(rule), *names, F.lit(0).alias("_rules"), (F.col("n") * F.col("_times")).alias("_inside"))
    named = rules.select(quoted(rule), *names, F.lit(1).alias("_rules"), F.lit(0).alias("_inside"))
    summed = named.unionByName(inside).groupBy(quoted(rule), *names).agg(F.sum("_rules").alias("_rules"), F.sum("_inside").alias("_inside"))
    n = F.coalesce("n", F.lit(0)) * F.col("_rules")
    out = n - F.col("_inside")
    return summed.join(totals, list(by), "left").select(
        quoted(rule), *names, n.alias("n"), out.alias("outside"), F.when(n > 0, out / n).alias("outside_ratio")
    )
