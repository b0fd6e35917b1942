"""Token ids as Parquet list columns, in ascending document order, read back selectively.

One row holds one document: its id, its number of tokens and its ids. Ids are dictionary encoded
(a vocabulary fits a dictionary page), document ids and lengths delta encoded; row groups and
pages are small enough that a reader that wants a few documents, or only the lengths, touches
little: Parquet's column and offset indexes are written for every column.

Nulls and repeats: a null text is an empty text, which yields the end id alone; a null document
id sorts first; documents that share an id lie side by side in any order. Other columns of the
input do not matter. An empty input yields an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, chunks, column, lists
from sensorlens.llm.token_ids import END_ID, WordEncoder

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
STORED = "doc_id long, n_tokens long, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """Documents as (doc_id, n_tokens, ids); the order of rows stays."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(tokenizer)
        for part in chunks(batches):
            ids, sizes = encoder.encode(column(part, "text"), end_id)
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), pa.array(sizes), lists(ids, sizes, pa.int32())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), encode, STORED)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Write the ids of all documents under ``path``; files and rows ascend by ``doc_id``.

    Texts, not ids, go through the exchange, so that sampling its ranges encodes nothing.
    """
    # rows that share an id, or have none, are spread by their texts
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id")
    (
        encoded(ordered, tokenizer, end_id)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .parquet(path)
    )


def read_tokens(
    spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """The stored rows, or those of some documents; without ids only the short columns are read."""
    stored = spark.read.schema(STORED).parquet(path)
    if doc_ids is not None:
        stored = stored.filter(F.col("doc_id").isin(list(doc_ids)))
    return stored if with_ids else stored.drop("ids")


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Add ``start``, the ids before each stored document, to rows that carry ``file`` and ``row``.

    Sums per file come first; the offsets of files are then added to the sums within each file,
    so no task sees the documents of more than one file. One row per file reaches one task.
    """
    lengths = spark.read.schema(STORED).parquet(path).select(
        F.col("_metadata.file_name").alias("file"), "n_tokens"
    )
    earlier = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = lengths.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    files = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    above = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(above), F.lit(0))
    return (
        rows.withColumn("within", within)
        .join(files, "file")
        .withColumn("start", F.col("before") + F.col("within"))
        .drop("before", "within", "file", "row")
    )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start, n_tokens and the crc32 of its ids, all from the files."""
    stored = spark.read.schema(STORED).parquet(path).select(
        "doc_id",
        "ids",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "ids")
            bounds = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4"))
            raw = raw.cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(crc, pa.int64()),
                    column(batch, "file"),
                    column(batch, "row"),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "file", "row"],
            )

    schema = "doc_id long, n_tokens long, ids_crc32 long, file string, row long"
    rows = arrow_map(stored, digest, schema)
    return with_starts(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
