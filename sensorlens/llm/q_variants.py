"""op12: words of the documents and the spelling each is a variant of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.registry import query, table
from sensorlens.llm.variants import variants, word_counts


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = word_counts(table(spark, sf_dir, "documents"), dropped=97)
    words = counted.filter((F.length("word") >= 5) & (F.col("n") >= 3))
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
