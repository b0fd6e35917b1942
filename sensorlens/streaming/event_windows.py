"""Windows over rows that arrive out of order, with late rows kept aside and counted.

Two streams in a row. :func:`split_late` sorts each batch into rows whose window may still be open and
late ones, by a watermark kept in a small table: the latest time of all earlier batches less ``delay``. Each batch
writes its own folders, so a batch that is run again replaces what it wrote, and every row that arrived lies in exactly one of
``rows``, ``late`` and ``untimed``. :func:`start_windows` then runs Spark's own windows over ``rows``: state holds the windows that the
watermark has not passed, results are appended when it does, and nothing is dropped silently
because what it would drop is in ``late`` already.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorlens.functions.columns import quoted, require_columns
from sensorlens.functions.frames import new_folder

SIDES = ("rows", "late", "untimed")
MARK = "batch long, latest timestamp, n_rows long, n_late long, n_untimed long"


def tumbling(time: str, width: str) -> Column:
    return F.window(quoted(time), width)


def session(time: str, gap: str) -> Column:
    return F.session_window(quoted(time), gap)


def _read(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(folder) if there else None


def marks(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, latest, n_rows, n_late, n_untimed): what each batch brought, from the written table."""
    kept = _read(spark, f"{folder}/marks", MARK)
    return spark.createDataFrame([], MARK) if kept is None else kept


def split_late(
    stream: DataFrame,
    folder: str,
    time: str,
    delay: str,
    width: str | None = None,
    gap: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Deal arriving rows into the folders ``rows``, ``late`` and ``untimed`` under ``folder``.

    A row is late if its window of ``width``, or a session that it would begin with ``gap``, ends at or before the
    watermark. Rows without a time have no window.
    """
    if (width is None) == (gap is None):
        raise ValueError("either a width of windows or a gap between sessions is needed")
    require_columns(stream, [time])
    spark = stream.sparkSession
    if checkpoint is None:
        checkpoint = new_folder(spark, "late")
    ends = F.window(quoted(time), width)["end"] if width else quoted(time).cast("timestamp") + F.expr(f"interval {gap}")

    def deal(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        before = marks(own, folder).filter(F.col("batch") < batch_id)
        row = before.agg((F.max("latest") - F.expr(f"interval {delay}")).alias("mark")).first()
        mark = F.lit(row["mark"]).cast("timestamp")
        side = F.when(quoted(time).isNull(), F.lit("untimed")).when(F.col("_ends") <= mark, F.lit("late")).otherwise(F.lit("rows"))
        sorted_ = batch.withColumn("_ends", ends) if gap else _with_window_end(batch, time, width)
        sorted_ = sorted_.withColumn("_side", side).drop("_ends").persist()
        try:
            for name in SIDES:
                part = sorted_.filter(F.col("_side") == name).drop("_side")
                part.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
            counts = [F.count_if(F.col("_side") == name).alias(f"n_{name}") for name in SIDES]
            own_mark = sorted_.agg(F.max(quoted(time).cast("timestamp")).alias("latest"), *counts)
            own_mark = own_mark.select(F.lit(batch_id).cast("long").alias("batch"), "latest", "n_rows", "n_late", "n_untimed")
            own_mark.write.mode("overwrite").parquet(f"{folder}/marks/part={batch_id}")
        finally:
            sorted_.unpersist()

    return (
        stream.writeStream.foreachBatch(deal)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _with_window_end(batch: DataFrame, time: str, width: str) -> DataFrame:
    """The end of each row's window; rows without a time, which windows leave out, stay."""
    timed = batch.withColumn("_ends", F.window(quoted(time), width)["end"])
    return timed.unionByName(batch.filter(quoted(time).isNull()).withColumn("_ends", F.lit(None).cast("timestamp")))


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows that came too late for their window, with the batch that brought them."""
    kept = _read(spark, f"{folder}/late", T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.LongType())])) if kept is None else kept


def start_windows(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    time: str,
    delay: str,
    window: Column,
    aggregates: Mapping[str, Column],
    output: str,
    by: tuple[str, ...] = (),
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Append closed windows to ``output``: window_start, window_end, the columns ``by`` and the aggregates.

    Batches of :func:`split_late` are taken whole; state holds open windows only. A fixed ``checkpoint`` lets a
    later run go on with them.
    """
    if checkpoint is None:
        checkpoint = new_folder(spark, "windows")
    arrived = spark.readStream.schema(schema).parquet(f"{folder}/rows/*")
    grouped = arrived.withWatermark(time, delay).groupBy(window.alias("_w"), *[quoted(c) for c in by])
    closed = grouped.agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *[quoted(c) for c in by], *[quoted(n) for n in aggregates]
    )
    return (
        closed.writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dropped_rows(query: StreamingQuery) -> int:
    """What Spark itself dropped as late: none, where rows came through :func:`split_late`."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
