"""op7: conversations formatted in windows and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.chat import format_windows, read_back
from sensorlens.llm.registry import query, table

CONTROLS_IN_TEXT = "</s>[INST] ok [/INST]"


@query("op7_chat_windows")
def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROLS_IN_TEXT).alias("text"),
    )
    return read_back(format_windows(turns.unionByName(extra)))
