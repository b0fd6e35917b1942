"""Queries over rows in time: as-of joins, rolling windows, streamed windows and sketches."""

from __future__ import annotations


from pyspark.sql import functions as F

from sensorlens.functions.frames import new_folder
from sensorlens.operators import temporal
from sensorlens.plans.catalog import query
from sensorlens.plans.tables import table
from sensorlens.streaming import event_windows, sketch_stream
from sensorlens.streaming.profile_stream import file_stream


@query("c01_as_of_join", """with r as (select user_id, ts, max(struct_pack(v := value, e := event_id)) as held from events where event_type = 'view' group by 1, 2)
 select l.event_id, l.user_id, l.ts, l.value, r.held.v as asof_value, r.held.e as asof_event_id
 from (select * from events where event_type <> 'view') l asof left join r on l.user_id = r.user_id and l.ts >= r.ts""")
def c01(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    views = events.filter("event_type = 'view'")
    others = events.filter("event_type <> 'view'").drop("event_type")
    return temporal.as_of_join(others, views, "user_id", "ts", columns=["value", "event_id"])


@query("c02_as_of_hot_key", """with r as (select event_type, ts, max(value) as v from events where user_id % 2 = 0 group by 1, 2)
 select l.event_id, r.v as asof_value from (select * from events where user_id % 2 = 1) l
 asof join r on l.event_type = r.event_type and l.ts > r.ts where l.ts - r.ts <= interval 2 hours""")
def c02(spark, sf_dir):
    """Five keys hold all rows, so each key spans several ranges; only earlier rows of two hours count."""
    events = table(spark, sf_dir, "events")
    even, odd = events.filter("user_id % 2 = 0"), events.filter("user_id % 2 = 1").select("event_id", "event_type", "ts")
    found = temporal.as_of_join(odd, even, "event_type", "ts", columns=["value"], allow_equal=False, tolerance="2 hours", how="inner")
    return found.select("event_id", "asof_value")


def _rolling_sql(key: str, width: str) -> str:
    over = f"over (partition by {key} order by ts range between interval {width} preceding and current row)"
    return f"""select event_id, count(value) {over} as n, round(sum(value) {over}, 2) as total, round(avg(value) {over} * count(value) {over}, 2) as mean_times_n,
 min(value) {over} as low, max(value) {over} as high from events"""


def _rolling(spark, sf_dir, key, width):
    made = {"n": ("count", "value"), "total": ("sum", "value"), "mean": ("mean", "value"), "low": ("min", "value"), "high": ("max", "value")}
    found = temporal.rolling(table(spark, sf_dir, "events"), key, "ts", width, made)
    return found.select("event_id", "n", F.round("total", 2).alias("total"), F.round(F.col("mean") * F.col("n"), 2).alias("mean_times_n"), "low", "high")


@query("c03_rolling_per_user", _rolling_sql("user_id", "3 days"))
def c03(spark, sf_dir):
    return _rolling(spark, sf_dir, "user_id", "3 days")


@query("c04_rolling_hot_key", _rolling_sql("event_type", "5 hours"))
def c04(spark, sf_dir):
    return _rolling(spark, sf_dir, "event_type", "5 hours")


@query("c05_previous_value", """with r as (select user_id, ts, max(value) as v from events group by 1, 2)
 select l.event_id, r.v as previous_value from events l asof left join r on l.user_id = r.user_id and l.ts > r.ts""")
def c05(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return temporal.changes(events, "user_id", "ts", ["value"]).select("event_id", "previous_value")


# Rows arrive in four batches by time; every tenth comes one batch later, every 37th two.
_BATCH = """least(3, cast(floor((epoch_us(ts) - lo) * 4 / (hi - lo + 1)) as int) + case when event_id % 37 = 0 then 2 when event_id % 10 = 0 then 1 else 0 end)"""
_ARRIVED = f"""with e as (select *, min(epoch_us(ts)) over () as lo, max(epoch_us(ts)) over () as hi from events),
 b as materialized (select event_id, ts, user_id, event_type, value, {_BATCH} as batch from e),
 m as (select k, (select max(ts) from b where batch < k) - interval 1 day as mark from range(4) r(k)),"""


def _arrivals(spark, sf_dir):
    """The events as four files, read one to a batch, and the schema they have."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"), "user_id", "event_type", "value")
    at = F.unix_micros("ts")
    low, high = events.agg(F.min(at), F.max(at)).first()
    own = F.floor((at - low) * 4 / F.lit(high - low + 1))
    behind = F.when(F.col("event_id") % 37 == 0, 2).when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    folder = new_folder(spark, "arrivals")
    for batch in range(4):
        arrived = events.filter(F.least(F.lit(3), own.cast("int") + behind) == batch)
        arrived.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return file_stream(spark, f"{folder}/in", events.schema, files_per_batch=1), events.schema, folder


def _untimed(windows):
    """Watermarks need times with a zone; the events have none."""
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _split(spark, sf_dir, **windows):
    stream, schema, folder = _arrivals(spark, sf_dir)
    event_windows.split_late(stream, folder, "ts", "1 day", **windows).awaitTermination()
    return schema, folder


@query("c06_stream_late_rows", _ARRIVED + """ w as (select b.*, time_bucket(interval 6 hours, ts) + interval 6 hours as ends from b)
 select event_id, batch::bigint as batch from w join m on m.k = w.batch where ends <= mark""")
def c06(spark, sf_dir):
    schema, folder = _split(spark, sf_dir, width="6 hours")
    return event_windows.late_rows(spark, folder, schema).select("event_id", "batch")


def _aggregates():
    return {"n": F.count("*"), "total": F.round(F.sum("value"), 2), "high": F.max("value")}


@query("c07_stream_tumbling_windows", _ARRIVED + """ w as (select b.*, time_bucket(interval 6 hours, ts) as starts from b),
 t as (select w.* from w join m on m.k = w.batch where mark is null or starts + interval 6 hours > mark),
 x as (select max(ts) - interval 1 day as mark from t)
 select starts as window_start, starts + interval 6 hours as window_end, event_type, count(*) as n, round(sum(value), 2) as total, max(value) as high
 from t, x where starts + interval 6 hours <= mark group by 1, 2, 3""")
def c07(spark, sf_dir):
    schema, folder = _split(spark, sf_dir, width="6 hours")
    window = event_windows.tumbling("ts", "6 hours")
    event_windows.start_windows(spark, folder, schema, "ts", "1 day", window, _aggregates(), f"{folder}/closed", ("event_type",)).awaitTermination()
    return _untimed(spark.read.parquet(f"{folder}/closed"))


@query("c08_stream_sessions", _ARRIVED + """ t as (select b.* from b join m on m.k = b.batch where mark is null or ts + interval 8 hours > mark),
 x as (select max(ts) - interval 1 day as mark from t),
 s as (select *, case when ts < lag(ts) over (partition by user_id order by ts) + interval 8 hours then 0 else 1 end as first from t),
 g as (select *, sum(first) over (partition by user_id order by ts rows unbounded preceding) as nr from s),
 d as (select user_id, nr, min(ts) as window_start, max(ts) + interval 8 hours as window_end, count(*) as n, round(sum(value), 2) as total, max(value) as high from g group by 1, 2)
 select window_start, window_end, user_id, n, total, high from d, x where window_end <= mark""")
def c08(spark, sf_dir):
    schema, folder = _split(spark, sf_dir, gap="8 hours")
    window = event_windows.session("ts", "8 hours")
    event_windows.start_windows(spark, folder, schema, "ts", "1 day", window, _aggregates(), f"{folder}/closed", ("user_id",)).awaitTermination()
    return _untimed(spark.read.parquet(f"{folder}/closed"))


SKETCHED = ["event_id", "user_id", "value"]
_SKETCH_SQL = " union all ".join(
    f"""select '{c}' as "column", p, count({c}) as n, count(*) - count({c}) as missing, min({c})::double as "min", max({c})::double as "max",
 true as rank_within, true as distinct_within from events, (values (0.01::double), (0.25::double), (0.5::double), (0.95::double), (0.999::double)) v(p) group by p""" for c in SKETCHED)


@query("a62_stream_sketches", _SKETCH_SQL)
def a62_sketches(spark, sf_dir):
    """Merged sketches of four batches; ranks and distinct counts are held against the exact ones."""
    stream, _, folder = _arrivals(spark, sf_dir)
    sketch_stream.start_sketches(stream, f"{folder}/sketches", SKETCHED).awaitTermination()
    report = sketch_stream.sketch_report(sketch_stream.read_sketches(spark, f"{folder}/sketches"), (0.01, 0.25, 0.5, 0.95, 0.999))
    rows, events = report.collect(), table(spark, sf_dir, "events")
    ranks = [F.count_if(F.col(r["column"]).cast("double") <= r["value"]).alias(f"u{i}") for i, r in enumerate(rows)]
    below = [F.count_if(F.col(r["column"]).cast("double") < r["value"]).alias(f"b{i}") for i, r in enumerate(rows)]
    exact = events.agg(*ranks, *below, *[F.countDistinct(c).alias(f"d_{c}") for c in SKETCHED]).first()
    checked = [
        (r["column"], r["p"], r["n"], r["missing"], r["min"], r["max"],
         exact[f"b{i}"] - 0.01 * r["n"] <= r["p"] * r["n"] <= exact[f"u{i}"] + 0.01 * r["n"],
         abs(r["distinct"] - exact[f"d_{r['column']}"]) <= 0.03 * exact[f"d_{r['column']}"] + 1)
        for i, r in enumerate(rows)
    ]
    schema = "`column` string, p double, n long, missing long, min double, max double, rank_within boolean, distinct_within boolean"
    return spark.createDataFrame(checked, schema)
