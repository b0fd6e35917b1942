"""What the two vector searches share: usable vectors, shards and the final ranking."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of rows with an id and a vector whose components are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    doubles = F.transform(vector, lambda x: x.cast("double"))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("v")
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros, which adds nothing to a product."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    width = width or int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    ends = np.cumsum(sizes)
    for i, (end, n) in enumerate(zip(ends, sizes)):
        out[i, : min(n, width)] = flat[end - n : end][:width]
    return out


def cells(rows: DataFrame, queries: DataFrame, per_shard: int, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Rows dealt into shards and queries into blocks, each shard meeting each block in a cell.

    Ids are hashed, so no shard outgrows the others. A row is sent once per block of queries and
    a query once per shard; what a task holds is one shard and one block.
    """
    shards = max(1, math.ceil(rows.count() / per_shard))
    blocks = max(1, math.ceil(queries.count() / per_block))

    def dealt(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    placed = rows.withColumn("shard", dealt(1, shards)).withColumn("block", every_block)
    asked = queries.withColumn("block", dealt(2, blocks)).withColumn("shard", every_shard)
    return placed, asked


def one_per_id(queries: DataFrame) -> DataFrame:
    """An id that comes more than once asks once, with the smallest of its vectors."""
    return queries.groupBy("vec_id").agg(F.min("v").alias("v"))


def ranked(found: DataFrame, k: int, score: Column) -> DataFrame:
    """The best k of what all shards found for a query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
