"""What the operators share: Arrow maps over whole texts and vectorised text hashing.

Hashes are 64 bits wide and depend on the bytes alone, so they agree between tasks and runs.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CHUNK_BYTES = 4_000_000  # text handled at once inside a task, one longer text aside

Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def arrow_map(df: DataFrame, fn: Mapper, schema: str) -> DataFrame:
    let_workers_import(df.sparkSession)
    return df.mapInArrow(fn, schema)


def spread(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """As many partitions as the session shuffles into, by key or evenly."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece stay near ``size`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            if stop - start == batch.num_rows:
                yield batch
            else:  # a copy, as kernels on strings differ in how they treat offsets
                yield batch.take(pa.array(np.arange(start, stop)))
            start = stop


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by a line end; where each begins, and the end."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    empty, line_end = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    ended = pc.binary_join_element_wise(plain, empty, line_end)
    _, offsets, data = ended.buffers()
    bounds = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + len(ended) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """The same ``n`` 64-bit values for a seed everywhere."""
    steps = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64)))


BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64
_BYTE_VALUES = random_words(256, 1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class SubstringHash:
    """Hashes of any byte ranges of one array, each in constant time."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        self._sums = sums

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space; the array ends in white space."""
    solid = ~WHITE[data]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(data) and solid[0]:
        edges = np.concatenate([[0], edges])
    return edges[0::2], edges[1::2]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array from values laid end to end and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def blobs(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array: the values of each row as little-endian bytes."""
    flat = np.ascontiguousarray(flat)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * flat.itemsize
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), buffers)
    return made.cast(pa.binary())


def split_blobs(blob: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The reverse of ``blobs``: flat values and counts."""
    whole = pc.fill_null(blob.cast(pa.large_binary()), b"")
    _, offsets, data = whole.buffers()
    bounds = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    flat = raw[bounds[0] : bounds[-1]].view(dtype)
    return flat, np.diff(bounds) // np.dtype(dtype).itemsize
