"""op9: documents written as token ids and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm.registry import query, table
from sensorlens.llm.tables import new_path
from sensorlens.llm.token_ids import default_tokenizer
from sensorlens.llm.tokens import digests, write_tokens


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return digests(spark, path)
