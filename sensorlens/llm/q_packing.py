"""op3: all documents packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm.packing import pack
from sensorlens.llm.registry import query, table
from sensorlens.llm.token_ids import default_tokenizer


@query("op3_curve_packing")
def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer(), with_ids=False)
