"""op5: the quality of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.quality import fit, held_out, score
from sensorlens.llm.registry import query, table

GOOD_FROM = 0.3


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )
