"""Rows in time against plain loops; streamed windows and sketches against batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlens.operators import temporal
from sensorlens.operators.profile import column_stats
from sensorlens.streaming import event_windows, sketch_stream
from sensorlens.streaming.profile_stream import file_stream

START = datetime(2024, 3, 1)


def rows_in_time(n, seed, keys):
    rng = random.Random(seed)
    rows = [(i, rng.choice(keys), START + timedelta(minutes=rng.randrange(4_000)), float(rng.randrange(100))) for i in range(n)]
    return [*rows, (n, None, START, 1.0), (n + 1, keys[0], None, 2.0)]


SCHEMA = "id long, k string, t timestamp, v double"


@pytest.mark.parametrize("keys", ["a", "aaaaaaaaab", "abcdefgh"])
@pytest.mark.parametrize("allow_equal, tolerance", [(True, None), (False, None), (True, 30)])
def test_as_of_join(spark, keys, allow_equal, tolerance):
    left, right = rows_in_time(300, 1, keys), rows_in_time(200, 2, keys)
    found = temporal.as_of_join(
        spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA), "k", "t",
        columns=["v"], allow_equal=allow_equal, tolerance=f"{tolerance} minutes" if tolerance else None,
    )
    want = []
    for i, k, t, _ in left:
        met = [(s, v) for _, l, s, v in right if None not in (k, l, s, t) and l == k and (s < t or allow_equal and s == t)]
        met = [m for m in met if tolerance is None or m[0] >= t - timedelta(minutes=tolerance)]
        want.append((i, max(met)[1] if met else None))
    assert sorted(map(tuple, found.select("id", "asof_v").collect())) == sorted(want)


def test_a_hot_key_spans_ranges(spark):
    df = spark.createDataFrame([(i, "hot", START + timedelta(minutes=i), float(i)) for i in range(400)], SCHEMA)
    found = temporal.changes(df, "k", "t", ["v"])
    assert [r["previous_v"] for r in found.orderBy("id").collect()] == [None, *map(float, range(399))]
    parts = found.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 400


def test_as_of_empty_sides_and_inner(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows_in_time(5, 1, "ab"), SCHEMA)
    assert temporal.as_of_join(none, some, "k", "t").count() == 0
    assert temporal.as_of_join(some, none, "k", "t").filter("asof_v is null").count() == 7
    assert temporal.as_of_join(some, none, "k", "t", how="inner").count() == 0
    with pytest.raises(ValueError):
        temporal.as_of_join(some, some, "k", "t", how="outer")


@pytest.mark.parametrize("closed", ["both", "right"])
@pytest.mark.parametrize("keys", ["a", "abc"])
def test_rolling(spark, keys, closed):
    rows = rows_in_time(500, 3, keys)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_block", F.lit(1)).drop("_block").repartition(3)
    made = {"n": ("count", "v"), "total": ("sum", "v"), "mean": ("mean", "v"), "low": ("min", "v"), "high": ("max", "v")}
    got = {r["id"]: tuple(r)[4:] for r in temporal.rolling(df, "k", "t", "45 minutes", made, closed).collect()}
    for i, k, t, _ in rows:
        span = timedelta(minutes=45)
        held = [v for _, l, s, v in rows if None not in (s, t) and l == k and s <= t and (t - s < span or closed == "both" and t - s == span)]
        assert got[i] == ((len(held), sum(held), sum(held) / len(held), min(held), max(held)) if held else (None,) * 5)
    assert len(got) == len(rows)


def test_rolling_splits_a_hot_key_over_blocks(spark):
    df = spark.createDataFrame([(i, "hot", START + timedelta(minutes=i), 1.0) for i in range(2_000)], SCHEMA)
    plan = temporal.rolling(df, "k", "t", "10 minutes", {"n": ("count", "v")})
    assert plan.filter("n <> least(id + 1, 11)").count() == 0
    exchanged = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in exchanged and "_in" in exchanged.split("hashpartitioning(k")[1][:20]
    for bad in ({"n": ("median", "v")},):
        with pytest.raises(ValueError):
            temporal.rolling(df, "k", "t", "10 minutes", bad)


def test_rolling_costs_no_more_where_windows_hold_more(spark):
    # a sliding frame adds up a window anew for every row; running frames begin without a bound
    df = spark.createDataFrame([(i, "hot", START + timedelta(seconds=i // 3), float(i % 7)) for i in range(900)], SCHEMA)
    made = {"n": ("count", "v"), "d": ("sum", "w"), "m": ("mean", "w"), "low": ("min", "v")}
    rolled = temporal.rolling(df.withColumn("w", F.col("v").cast("decimal(10,2)")), "k", "t", "2 minutes", made, "right")
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe" in plan and plan.count("specifiedwindowframe") == plan.count("unboundedpreceding$()")
    assert dict(rolled.dtypes)["d"] == "decimal(20,2)" and dict(rolled.dtypes)["m"] == "decimal(14,6)"
    row = rolled.filter("id = 899").first()
    held = [i % 7 for i in range(540, 900)]
    assert (row["n"], float(row["d"]), row["low"]) == (360, sum(held), 0.0) and abs(float(row["m"]) - sum(held) / 360) < 1e-6


def batches(spark, folder, parts):
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_every_row_is_kept_once_and_late_ones_aside(spark, tmp_path):
    at = lambda m: START + timedelta(minutes=m)
    parts = [
        [(1, "a", at(5), 1.0), (2, "a", at(65), 1.0), (3, "b", None, 1.0)],
        [(4, "a", at(59), 1.0), (5, "a", at(200), 1.0)],  # the first hour is still open: the watermark stands at 35
        [(6, "a", at(30), 1.0), (7, "a", at(150), 1.0), (8, "a", at(119), 1.0)],  # at 170 two hours are closed
        [(9, "b", at(500), 1.0)],
    ]
    stream = batches(spark, str(tmp_path / "in"), parts)
    event_windows.split_late(stream, str(tmp_path / "out"), "t", "30 minutes", width="1 hour", checkpoint=str(tmp_path / "c")).awaitTermination()
    late = event_windows.late_rows(spark, str(tmp_path / "out"), stream.schema)
    assert sorted((r["id"], r["batch"]) for r in late.collect()) == [(6, 2), (8, 2)]
    marks = event_windows.marks(spark, str(tmp_path / "out")).orderBy("batch").collect()
    assert [(r["n_rows"], r["n_late"], r["n_untimed"]) for r in marks] == [(2, 0, 1), (2, 0, 0), (1, 2, 0), (1, 0, 0)]
    query = event_windows.start_windows(
        spark, str(tmp_path / "out"), stream.schema, "t", "30 minutes", event_windows.tumbling("t", "1 hour"),
        {"n": F.count("*")}, str(tmp_path / "closed"), ("k",), str(tmp_path / "w"),
    )
    query.awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "closed")).orderBy("window_start").collect()
    assert [(r["window_start"], r["k"], r["n"]) for r in closed] == [(at(0), "a", 2), (at(60), "a", 1), (at(120), "a", 1), (at(180), "a", 1)]
    assert event_windows.dropped_rows(query) == 0
    with pytest.raises(ValueError):
        event_windows.split_late(stream, "x", "t", "1 hour")


def test_windows_go_on_from_their_state(spark, tmp_path):
    at = lambda m: START + timedelta(minutes=m)
    folder, schema = str(tmp_path / "out"), spark.createDataFrame([], SCHEMA).schema
    for part in ([(1, "a", at(5), 1.0)], [(2, "a", at(9), 1.0), (3, "a", at(300), 1.0)]):
        stream = batches(spark, str(tmp_path / "in"), [part])
        event_windows.split_late(stream, folder, "t", "10 minutes", gap="15 minutes", checkpoint=str(tmp_path / "c")).awaitTermination()
        event_windows.start_windows(
            spark, folder, schema, "t", "10 minutes", event_windows.session("t", "15 minutes"), {"n": F.count("*")},
            str(tmp_path / "closed"), ("k",), str(tmp_path / "w"),
        ).awaitTermination()
    closed = [(r["window_start"], r["window_end"], r["n"]) for r in spark.read.parquet(str(tmp_path / "closed")).collect()]
    assert closed == [(at(5), at(24), 2)]


def test_sketches_of_any_batches_agree(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "value")
    exact = sorted(r["value"] for r in events.collect())
    for n in (1, 3, 7):
        folder = str(tmp_path / f"s{n}")
        events.repartition(n).write.parquet(folder + "/in")
        stream = file_stream(spark, folder + "/in", events.schema, files_per_batch=1)
        sketch_stream.start_sketches(stream, folder + "/out").awaitTermination()
        kept = sketch_stream.read_sketches(spark, folder + "/out")
        assert kept.count() == 2 * n
        stats = {r["column"]: r for r in column_stats(events).collect()}
        for r in sketch_stream.sketch_report(kept, (0.0, 0.1, 0.5, 0.99, 1.0)).collect():
            assert (r["n"], r["missing"], r["min"], r["max"]) == tuple(stats[r["column"]][c] for c in ("n", "missing", "min", "max"))
            if r["column"] == "value":
                below, upto = sum(x < r["value"] for x in exact), sum(x <= r["value"] for x in exact)
                assert below - 0.01 * len(exact) <= r["p"] * len(exact) <= upto + 0.01 * len(exact)
                assert abs(r["distinct"] - len(set(exact))) <= 0.03 * len(set(exact)) + 1
        assert sketch_stream.read_sketches(spark, folder + "/out", [0]).count() == 2


def test_sketches_of_missing_values(spark, frame):
    df = frame("a double, b int", (None, None), (float("nan"), None), (0.0, 1), (-0.0, 1))
    kept = sketch_stream.sketch_batch(df).unionByName(sketch_stream.sketch_batch(df.limit(0)))
    got = sketch_stream.sketch_report(kept, (0.5,)).orderBy("ordinal").collect()
    assert [(r["column"], r["n"], r["missing"], r["distinct"], r["value"]) for r in got] == [("a", 2, 2, 1, 0.0), ("b", 2, 2, 1, 1.0)]
    none = sketch_stream.sketch_report(sketch_stream.sketch_batch(df.limit(0)), (0.5,)).collect()
    assert [(r["n"], r["value"], r["distinct"]) for r in none] == [(0, None, 0)] * 2
    with pytest.raises(ValueError):
        sketch_stream.sketch_report(kept, (1.5,))
