import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.operators.order_stats import order_statistics, quantiles, smallest_rows
from sensorlens.operators import order_stats, ranks
from sensorlens.operators.keys import salted_rows
from sensorlens.operators.ranks import attach_by_key, average_ranks, running_totals


def test_quartet_quartiles(numbers):
    got = quantiles(numbers(1, 2, 3, 4), ["x"], (0.25, 0.5, 0.75))["x"]
    assert got == pytest.approx([1.75, 2.5, 3.25])


def test_no_values(numbers):
    assert quantiles(numbers(None, None), ["x"], (0.5,)) == {"x": [None]}


@pytest.mark.parametrize("bound", [1, 7, 10_000])
def test_narrowing_equals_numpy(spark, bound):
    rng = random.Random(5)
    values = [rng.gauss(0, 10) for _ in range(2_000)] + [3.25] * 1_000 + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v, i % 11) for i, v in enumerate(values)], "x double, k int")
    probs = (0.0, 0.001, 0.25, 0.5, 0.51, 0.6, 0.999, 1.0)
    got = quantiles(df, ["x", "k"], probs, bound=bound)
    present = [v for v in values if v is not None]
    assert got["x"] == pytest.approx(np.quantile(present, probs), abs=1e-12)
    assert got["k"] == pytest.approx(np.quantile([i % 11 for i in range(len(values))], probs))


def test_hot_value_beside_the_rank(spark):
    """A value held by a third of the rows, next to the wanted ranks, must not stall the search."""
    values = [0.0] * 1_000 + [1.0 + i / 1000 for i in range(2_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ranks = [999, 1000, 1001, 2999]
    got = order_statistics(df, {"x": F.col("x")}, {"x": ranks}, bound=2)
    assert [got["x", r] for r in ranks] == [sorted(values)[r] for r in ranks]


def test_integers_that_share_a_double(spark):
    values = [2**60 + i % 10 for i in range(500)] + [5] * 20
    df = spark.createDataFrame([(v,) for v in values], "x long")
    ranks = [0, 19, 20, 69, 70, 300, 519]
    got = order_statistics(df, {"x": F.col("x")}, {"x": ranks}, bound=3)
    assert [got["x", r] for r in ranks] == [sorted(values)[r] for r in ranks]


def test_rank_out_of_range(numbers):
    with pytest.raises(ValueError):
        order_statistics(numbers(1, 2), {"x": F.col("x")}, {"x": [2]})


def test_smallest_rows_with_ties(spark):
    df = spark.createDataFrame([(i // 3, i) for i in range(60)], "k long, i int")
    got = sorted(r.k for r in smallest_rows(df, 10, "k").collect())
    assert got == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert smallest_rows(df, 100, "k").count() == 60


def test_smallest_rows_of_missing_and_text_keys(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 != 0, F.format_string("k%05d", "id")).alias("k"), "id"
    )
    assert smallest_rows(df, 5, "k").filter("k is null").count() == 5
    got = smallest_rows(df, 12_001, "k")
    assert (got.count(), got.filter("k is null").count()) == (12_001, 10_000)
    assert got.agg(F.max("k")).first()[0] == "k03001"
    assert smallest_rows(df, 30_000, "k").count() == smallest_rows(df, 50_000, "k").count() == 30_000


def test_look_alike_integers_are_ranked_as_they_are(spark):
    big = 2**60
    df = spark.range(40_000).select((F.col("id") + big).alias("x"))
    got = order_statistics(df, {"x": F.col("x")}, {"x": [0, 123, 39_999]})
    assert [got["x", r] for r in (0, 123, 39_999)] == [big, big + 123, big + 39_999]


def test_smallest_rows_among_identical_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b")] * 40 + [(2, "c")] * 2 + [(3, "d")], "k int, v string")
    got = smallest_rows(df, 30, "k")
    counts = {r.v: r["count"] for r in got.groupBy("v").count().collect()}
    assert counts["a"] == 3 and sum(counts.values()) == 30 and "d" not in counts
    assert got.exceptAll(df).count() == 0


@pytest.mark.parametrize("bound", [5, 10_000])
def test_running_totals_across_partitions(spark, bound):
    rows = [(f"k{i:03d}", i % 4 + 1) for i in range(40)]
    random.Random(1).shuffle(rows)
    got = running_totals(spark.createDataFrame(rows, "k string, w int"), "k", "w", bound)
    expected, total = {}, 0
    for k, w in sorted(rows):
        expected[k] = total
        total += w
    assert {r.k: r.before for r in got.collect()} == expected


@pytest.mark.parametrize("bound", [1, 10_000])
def test_attach_keeps_every_row(spark, bound):
    keys = ["hot"] * 300 + [f"c{i}" for i in range(50)] * 2 + [None] * 20 + ["stranger"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    lookup = spark.createDataFrame(
        [("hot", 300, 1.0)] + [(f"c{i}", 2, float(i)) for i in range(50)], "k string, n int, v double"
    )
    got = attach_by_key(df, lookup, "k", bound=bound)
    assert got.count() == len(keys) == got.select("i").distinct().count()
    values = {r.i: r.v for r in got.collect()}
    assert values[0] == 1.0 and values[len(keys) - 1] is None and values[305] == 5.0


@pytest.mark.parametrize("bound", [2, 10_000])
def test_average_ranks_share_ties(numbers, bound):
    got = {r.x: r.avg_rank for r in average_ranks(numbers(5, 1, 5, 9, None, 2), "x", bound).collect()}
    assert got == {1.0: 1.0, 2.0: 2.0, 5.0: 3.5, 9.0: 5.0}


def test_rank_plan_grows_by_one_join_a_column(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LOOKUP_BYTES", 0)
    df = spark.range(300).select(*[F.pmod(F.hash("id", F.lit(i)), F.lit(97)).alias(f"c{i}") for i in range(4)])
    sizes = []
    for n in (2, 3, 4):
        plan = ranks.replace_by_ranks(df, [f"c{i}" for i in range(n)], bound=5)
        sizes.append(plan._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
    assert sizes == [3, 4, 5]
    for i in range(4):
        want = ranks.average_ranks(df, f"c{i}").agg(F.sum(F.col("avg_rank") * F.col("n"))).first()[0]
        assert plan.agg(F.sum(f"c{i}")).first()[0] == want


def test_missing_and_new_hot_keys_are_spread(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 2 == 0, "unknown").alias("k"))
    salted = salted_rows(df, F.col("k").isNull() | (F.col("k") == "unknown"), 16)
    counts = [r["count"] for r in salted.groupBy("k", "_salt").count().collect()]
    assert len(counts) == 32 and max(counts) < 200


def test_number_keys_need_no_exchange_of_keys(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("keys went through an exchange")

    monkeypatch.setattr(order_stats, "value_at_rank", refuse)
    df = spark.range(40_000).select(
        F.col("id").alias("n"),
        (F.col("id") / 7).alias("x"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("d"),
        F.timestamp_micros(F.col("id") * 1_234_567 + F.lit(10**15)).alias("t"),
        (F.col("id") / 3).cast("decimal(18,4)").alias("m"),
        F.when(F.col("id") % 4 > 0, F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("id"))).alias("f"),
    )
    for key in ("n", "x", "d", "t", "m", "f"):
        got = smallest_rows(df, 15_000, key)
        assert got.count() == 15_000, key
        cut = df.orderBy(F.col(key).asc_nulls_first()).limit(15_000).agg(F.max(key)).first()[0]
        assert got.agg(F.max(key)).first()[0] == cut, key


def test_many_columns_and_types_in_one_search(spark):
    df = spark.range(30_000).select(
        (F.xxhash64("id") % 1_000).alias("a"), (F.xxhash64("id", F.lit(1)) / 2**40).alias("b"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("int")).alias("c"),
    )
    ranks = {"a": [0, 100, 15_000, 29_999], "b": [7, 29_000], "c": [0, 5_000, 9_999]}
    got = order_statistics(df, {c: F.col(c) for c in ranks}, ranks, bound=50)
    for c, wanted in ranks.items():
        values = sorted(r[0] for r in df.select(c).dropna().collect())
        assert [got[c, r] for r in wanted] == [values[r] for r in wanted], c


def test_salts_do_not_follow_the_order_of_rows(spark):
    df = spark.range(2_000).select((F.col("id") % 2).alias("k"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    salts = [
        {r.id: r._salt for r in salted_rows(d, F.lit(True), 16).collect()}
        for d in (df.coalesce(1), df.coalesce(1).sortWithinPartitions(F.desc("id")))
    ]
    assert salts[0] == salts[1] and len(set(salts[0].values())) == 16


def test_many_cuts_are_searched_as_they_are_compared(spark):
    cuts = [-0.0, *[i / 8 for i in range(1, 40)]]
    values = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, *cuts, *[c + 0.01 for c in cuts], *[c - 1e-17 for c in cuts]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert order_stats._splits(cuts) and order_stats._splits(cuts[:3]) is None
    near = [0.0, 5e-324, *[float(i) for i in range(1, 30)]]  # nothing lies between the first two
    assert order_stats._splits(near) is None and order_stats._splits([*cuts, float("nan")]) is None
    coded, _ = order_stats._bucketed(df, {"x": F.col("x")}, {"x": cuts}, with_value=True)
    wanted = df.filter("x is not null").select(order_stats._place(F.col("x"), cuts, 0, len(cuts)).alias("code"), F.col("x").alias("v"))
    key = lambda r: (r["code"], str(r["v"]))
    assert sorted(map(key, coded.collect())) == sorted(map(key, wanted.collect()))
