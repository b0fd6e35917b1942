"""op13: documents as ids of a byte-level BPE, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.byte_bpe import decode, encode, ids_digest
from sensorlens.llm.registry import query, table


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"))
    decoded = decode(encoded, keep=("doc_id", "n_tokens", "ids"))
    return decoded.select(
        "doc_id", "n_tokens", ids_digest().alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )
