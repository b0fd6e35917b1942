"""Percentiles and distinct counts over files that keep arriving, from mergeable sketches.

Every batch leaves one row per column: counts, a quantile sketch (KLL) and a distinct sketch (HLL).
Rows of batches merge in any order and grouping, so the profile of all that has arrived, or of any
span of batches, is an aggregate over a few small rows, and its error bound is that of one sketch. A
batch that is run again after a failure replaces its own row.

``k`` sets the rank error of quantiles (about 1.33% at 200, 0.35% at 800, with 99% confidence);
``lg_k`` the relative error of distinct counts (one sigma is 0.83 / sqrt(2 ** lg_k)).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlens.functions.columns import numeric_cols, quoted, require_columns
from sensorlens.functions.frames import long_report, new_folder

RANK_K = 800
DISTINCT_LG_K = 14
SKETCHES = "ordinal int, `column` string, n long, missing long, low double, high double, ranks binary, distinct binary"


def sketch_batch(df: DataFrame, cols: Sequence[str] | None = None, k: int = RANK_K, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """One row per numeric column, in one aggregate; NaN counts as missing."""
    names = numeric_cols(df) if cols is None else list(cols)
    require_columns(df, names)
    values = {c: F.nanvl(quoted(c).cast("double"), F.lit(None)) + F.lit(0.0) for c in names}
    aggs, rows = [], []
    for i, (c, v) in enumerate(values.items()):
        exact = quoted(c).cast("long") if dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint") else v.cast("string")
        aggs += [
            F.count(v).alias(f"n{i}"), F.min(v).alias(f"l{i}"), F.max(v).alias(f"h{i}"),
            F.kll_sketch_agg_double(v, k).alias(f"r{i}"), F.hll_sketch_agg(exact, lg_k).alias(f"d{i}"),
        ]
        rows.append({
            "ordinal": F.lit(i), "column": F.lit(c), "n": F.col(f"n{i}"), "missing": F.col("rows") - F.col(f"n{i}"),
            "low": F.col(f"l{i}"), "high": F.col(f"h{i}"), "ranks": F.col(f"r{i}"), "distinct": F.col(f"d{i}"),
        })
    return long_report(df.agg(F.count("*").alias("rows"), *aggs), rows)


def start_sketches(
    stream: DataFrame,
    folder: str,
    cols: Sequence[str] | None = None,
    checkpoint: str | None = None,
    k: int = RANK_K,
    lg_k: int = DISTINCT_LG_K,
) -> StreamingQuery:
    """Sketch all files present, batch by batch, into ``folder``; a fixed ``checkpoint`` lets a later run go on."""
    if checkpoint is None:
        checkpoint = new_folder(stream.sparkSession, "sketches")

    def keep(batch: DataFrame, batch_id: int) -> None:
        sketch_batch(batch, cols, k, lg_k).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_sketches(spark: SparkSession, folder: str, batches: Sequence[int] | None = None) -> DataFrame:
    """The rows of all batches so far, or of some."""
    kept = spark.read.schema(SKETCHES + ", batch long").parquet(folder)
    return kept if batches is None else kept.filter(F.col("batch").isin(list(batches)))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column from any number of rows per column; sketches without a value add nothing."""
    held = F.when(F.col("n") > 0, F.col("ranks"))
    return sketches.groupBy("ordinal", "column").agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double(held).alias("ranks"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def sketch_report(sketches: DataFrame, probabilities: Sequence[float] = (0.01, 0.05, 0.5, 0.95, 0.99)) -> DataFrame:
    """(ordinal, column, n, missing, min, max, distinct, p, value): a row per column and probability."""
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities must lie between 0 and 1, got {list(probabilities)}")
    merged = merge_sketches(sketches)
    held = F.when(F.col("n") > 0, F.col("ranks"))
    each = F.array(*[
        F.struct(
            F.lit(float(p)).alias("p"),
            F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(held, F.lit(float(p)))).alias("value"),
        )
        for p in probabilities
    ])
    return merged.select(
        "ordinal", "column", "n", "missing", F.col("low").alias("min"), F.col("high").alias("max"),
        F.hll_sketch_estimate("distinct").alias("distinct"), F.inline(each),
    )
