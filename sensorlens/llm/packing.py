"""Packing along a space-filling curve.

A document's token ids are hashed into a vector, which is projected to few dimensions; the
Hilbert key of that point is its place on a curve that keeps near points near. Documents are
range-sorted by key, a distributed prefix sum of lengths gives each its place in one long stream,
and the stream is cut into sequences of ``SEQUENCE`` ids. So neighbours on the curve share
sequences, a document is cut wherever a sequence ends, and only the last sequence of all is not
full. Which ids fall into which sequence follows from the place alone: no packing is done bin by
bin, and no task sees more than its own documents.

Nulls and repeats: a null text is empty and yields its end id alone; repeated rows and null ids
are documents of their own; documents with one key are ordered by the row's number, so a third
of all rows with one text are spread over as many ranges as they need. An empty table gives an
empty one; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, chunks, column, lists, random_words
from sensorlens.llm.tables import new_path, written
from sensorlens.llm.token_ids import END_ID, WordEncoder

SEQUENCE = 2048
HASHED = 64  # dimensions of a hashed document vector
AXES, BITS = 4, 12  # dimensions of the curve, and bits of each


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below ``2**bits``, a row each.

    Coordinates are turned, from the highest bit down, into the frame of the cell they lie in;
    Gray decoding then makes their interleaved bits count along the curve.
    """
    axes = points.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in axes:
            inverted = (axis & high) != 0
            swapped = np.where(inverted, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(inverted, low, swapped)
            axis ^= swapped
    for k in range(1, len(axes)):
        axes[k] ^= axes[k - 1]
    flip = np.zeros(points.shape[0], np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] & (1 << bit), (1 << bit) - 1, 0)
    axes ^= flip
    key = np.zeros(points.shape[0], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | ((axis >> bit) & 1)
    return key


def curve_keys(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document from its token ids, laid end to end."""
    drawn = random_words(int(ids.max(initial=0)) + 1, 17)[ids]
    slot = np.repeat(np.arange(len(sizes)) * HASHED, sizes) + (drawn % np.uint64(HASHED)).astype(np.int64)
    sign = 1.0 - 2.0 * (drawn >> np.uint64(63)).astype(float)
    vectors = np.bincount(slot, sign, minlength=len(sizes) * HASHED).reshape(-1, HASHED)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    projected = vectors @ np.random.default_rng(23).standard_normal((HASHED, AXES))
    spread = 1.0 / (1.0 + np.exp(-1.7 * projected))  # close to evenly spread over the unit cube
    return hilbert_key(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def encoded_on_curve(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """(row, doc_id, key, n, ids) of every document, written down: texts are encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(tokenizer)
        for part in chunks(batches):
            ids, sizes = encoder.encode(column(part, "text"), end_id)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "row"), column(part, "doc_id"), pa.array(curve_keys(ids, sizes)),
                    pa.array(sizes), lists(ids, sizes, pa.int32()),
                ],
                names=["row", "doc_id", "key", "n", "ids"],
            )

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return written(arrow_map(numbered, encode, "row long, doc_id long, key long, n long, ids array<int>"), "ids")


def stream_starts(encoded: DataFrame) -> DataFrame:
    """(row, place): how many ids of the whole stream lie before each document.

    Each range of keys is summed up while it is written; the sums of earlier ranges are added on
    reading. One row per range reaches one task.
    """
    spark = encoded.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            n = column(batch, "n").to_numpy(zero_copy_only=False)
            ends = total + np.cumsum(n)
            total = int(ends[-1]) if len(n) else total
            yield pa.RecordBatch.from_arrays(
                [column(batch, "row"), pa.array(ends - n), column(batch, "n")], names=["row", "inside", "n"]
            )

    schema = "row long, inside long, n long"
    path = new_path(spark, "stream")
    ordered = encoded.select("row", "key", "n").repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    arrow_map(ordered, run, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path).withColumn("file", F.col("_metadata.file_name"))
    earlier = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy("file").agg(F.sum("n").alias("total"))
    bases = sums.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return stored.join(bases, "file").select("row", (F.col("base") + F.col("inside")).alias("place"))


PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None = END_ID,
    length: int = SEQUENCE,
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece of a document: where it begins there, and its sequence and place in it.

    With ids each piece carries its own; ``sequences`` puts them together.
    """
    encoded = encoded_on_curve(docs, tokenizer, end_id)
    placed = encoded.select("row", "doc_id", "ids").join(stream_starts(encoded), "row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "ids")
            bounds = ids.offsets.to_numpy().astype(np.int64)
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")
            n = np.diff(bounds)
            place = column(batch, "place").to_numpy(zero_copy_only=False)
            # pieces end where the stream passes a whole number of sequences
            first, last = place // length, (place + np.maximum(n, 1) - 1) // length
            count = np.where(n > 0, last - first + 1, 0)
            doc = np.repeat(np.arange(len(n)), count)
            sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(sequence * length, place[doc])
            end = np.minimum((sequence + 1) * length, (place + n)[doc])
            at = bounds[doc] + begin - place[doc]
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at + end - begin)]
            columns = [
                column(batch, "doc_id").take(pa.array(doc)), pa.array(begin - place[doc]), pa.array(end - begin),
                pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(sequence), pa.array(begin - sequence * length),
            ]
            names = [f.split()[0] for f in PIECE.split(", ")]
            if with_ids:
                whole = np.concatenate([flat[a:b] for a, b in zip(at, at + end - begin)] or [flat[:0]])
                columns.append(lists(whole, end - begin, pa.int32()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(placed, cut, PIECE + (", ids array<int>" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): pieces with ids put together; a sequence has a bounded length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    gathered = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    return gathered.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
