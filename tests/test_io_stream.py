import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sensorlens.operators.profile import column_stats
from sensorlens.sources import sinks
from sensorlens.sources.reader import CsvOptions, ReadStrategy, parse_report, preview, read_csv, read_table
from sensorlens.streaming.profile_stream import file_stream, profile_available_files, start_profile


@pytest.mark.parametrize("bad", [{"mode": "half"}, {"sample_rows": 0}, {"chunk_size": -1}])
def test_strategy_is_checked_before_any_job(bad):
    with pytest.raises(ValueError):
        ReadStrategy(**bad)


def test_missing_path_and_key(spark, sf_dir):
    with pytest.raises(AnalysisException):
        read_table(spark, "/nowhere/at/all.parquet")
    with pytest.raises(ValueError):
        read_table(spark, f"{sf_dir}/orders.parquet", ReadStrategy("sample"))
    with pytest.raises(KeyError):
        read_table(spark, f"{sf_dir}/orders.parquet", ReadStrategy("sample"), "absent")


def test_read_modes(spark, sf_dir):
    path = f"{sf_dir}/orders.parquet"
    whole = read_table(spark, path)
    first = read_table(spark, path, ReadStrategy("sample", sample_rows=7), "o_orderkey")
    assert sorted(r.o_orderkey for r in first.collect()) == sorted(r.o_orderkey for r in preview(whole, "o_orderkey", 7).collect())
    chunk = read_table(spark, path, ReadStrategy("chunked", chunk_size=5), "o_orderkey")
    assert chunk.count() == 5
    rand = ReadStrategy("random_sample", sample_rows=9, random_state=3)
    one, two = (read_table(spark, path, rand, "o_orderkey") for _ in range(2))
    assert one.count() == 9 and one.exceptAll(two).count() == 0


def test_csv_tokens_and_dialect(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id;v;t\n1;1,5;a\n2;NA;\n3;;NULL\n4;NaN;b\n5;abc;c\n", encoding="latin-1")
    options = CsvOptions(sep=";", encoding="latin-1", decimal=",")
    df = read_csv(spark, str(tmp_path / "x.csv"), "id long, v double, t string", options)
    assert [r.v for r in df.orderBy("id").collect()] == [1.5, None, None, None, None]
    assert [r.t for r in df.orderBy("id").collect()] == ["a", None, None, "b", "c"]
    raw = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "x.csv"))
    r = parse_report(raw, ["v"], ",").first()
    assert (r["missing"], r["parsed"], r["failed"]) == (3, 1, 1)
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "x.csv"), None, options)
    with pytest.raises(KeyError):
        read_csv(spark, str(tmp_path / "x.csv"), "nope long", options)


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "y.csv").write_text("id,v\n1,2.5\n2,NaN\n")
    df = read_csv(spark, str(tmp_path / "y.csv"))
    assert dict(df.dtypes)["id"] == "int" and [r.v for r in df.orderBy("id").collect()] == [2.5, None]


def test_report_sink(spark, tmp_path):
    report = spark.range(9).select(F.col("id").alias("ordinal"), (F.col("id") * 2).alias("v"))
    for form in sinks.FORMATS:
        path = str(tmp_path / form)
        sinks.write_report(report, path, max_rows=4, format=form)
        back = spark.read.option("header", True).option("inferSchema", True).format(form).load(path)
        assert sorted(r.ordinal for r in back.collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        sinks.write_report(report, str(tmp_path / "z"), format="png")


def test_stream_equals_batch_and_continues(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    events.filter("event_id % 2 = 0").repartition(3).write.parquet(folder)
    first = start_profile(file_stream(spark, folder, events.schema, files_per_batch=1), "first_half", ["value"], state)
    first.awaitTermination()
    assert len(first.recentProgress) >= 3
    events.filter("event_id % 2 = 1").repartition(2).write.mode("append").parquet(folder)
    start_profile(file_stream(spark, folder, events.schema), "both_halves", ["value"], state).awaitTermination()
    fresh = profile_available_files(file_stream(spark, folder, events.schema), ["value"]).first()
    batch = column_stats(events, ["value"]).first()
    for got in (spark.table("both_halves").first(), fresh):
        assert (got["n"], got["missing"]) == (batch["n"], batch["missing"])
        for name in ("min", "max", "mean", "std"):
            assert got[name] == pytest.approx(batch[name], rel=1e-12)


def test_written_tables_go_after_the_session_has_stopped(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parents[1])!r})
from pyspark.sql import SparkSession
from sensorlens.functions.frames import materialise, new_folder
spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config(
    'spark.checkpoint.dir', {str(tmp_path)!r}).getOrCreate()
assert materialise(spark.range(3)).count() == 3
spark.range(2).write.parquet(new_folder(spark, 'arrivals'))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
    assert [p for p in tmp_path.rglob("*") if p.name.startswith(("table-", "arrivals-"))] == []
