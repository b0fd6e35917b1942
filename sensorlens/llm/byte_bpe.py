"""Byte-level BPE over Arrow batches: whole texts to token ids with offsets, and back to bytes.

The tokenizers library encodes; its model is made from a file of ranks. A rank file lists the
bytes of every token, the library wants characters and merges: each byte gets a printable
character, and a token's merge is the pair that the tokens of lower rank leave when they are
applied to its bytes. The library's byte-level splitter cuts texts into the matches of the same
pattern that the rank files are made for.

Offsets follow from the bytes: the lengths of a text's tokens add up to byte places, and byte
places map to code points by counting the bytes that begin one. A token that holds part of a
character starts at that character; so several tokens may share one, and none is without.

Decoding turns the table of characters round: ids become bytes by one lookup. A character whose
bytes lie in several tokens, or at the border of two pieces of a document, comes out whole as soon
as all of its bytes are there: a piece names how many of its bytes belong to characters that its
neighbours begin or end, and :func:`join_pieces` puts the bytes of a document's pieces together.

Very long texts are encoded in spans that end where white space follows another character: no match of
the pattern reaches over such a place, so the ids are those of the whole text.

Nulls and repeats: a null text is an empty one and has no ids; null ids decode to no bytes, a null id
in a list or one without a token is refused; rows that share an id are rows of their own. Other columns do not matter. Empty in, empty out.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, chunks, column, lists
from sensorlens.llm.token_ids import _ranges

SPAN_CHARS = 500_000  # what the library encodes at once of one text, as far as white space allows
BATCH_BYTES = 1_000_000  # texts encoded at once
SAFE_END = re.compile(r"[!-~](?=[ \n])")  # a visible ASCII character before white space
ENCODED = "doc_id long, n_tokens long, ids array<int>"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in itself}
    others = (b for b in range(256) if b not in chars)
    chars |= {b: chr(256 + n) for n, b in enumerate(others)}
    return [chars[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that make up a token when all tokens of lower rank have been merged."""
    limit, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        pairs = ((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        rank, at = min(pairs)
        if rank >= limit:
            raise ValueError(f"no merge makes the token {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class ByteBpe:
    """A tokenizer made from ranks, and the bytes of every token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks, chars = read_ranks(path), byte_characters()
        written = {token: "".join(chars[b] for b in token) for token in ranks}
        longer = sorted((t for t in ranks if len(t) > 1), key=ranks.get)
        merges = [tuple(written[p] for p in merge_of(t, ranks)) for t in longer]
        vocab = {written[t]: r for t, r in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        byte_of = {c: b for b, c in enumerate(chars)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        size = 1 + max(tokens)
        self.lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)

    @classmethod
    def shared(cls, path: str) -> ByteBpe:
        """One tokenizer for all tasks of a Python worker."""
        held = sys.modules[__name__].__dict__.setdefault("_TOKENIZERS", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text."""
        spans, of = [], []
        for i, text in enumerate(texts):
            start = 0
            while start < len(text):
                end = SAFE_END.search(text, start + SPAN_CHARS) if len(text) - start > SPAN_CHARS else None
                stop = end.end() if end else len(text)
                spans.append(text[start:stop] if stop - start < len(text) else text)
                of.append(i)
                start = stop
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(spans, add_special_tokens=False)]
        sizes = np.zeros(len(texts), np.int64)
        np.add.at(sizes, np.array(of, np.int64), np.fromiter(map(len, ids), np.int64, len(ids)))
        return np.fromiter((x for one in ids for x in one), np.int32, int(sizes.sum())), sizes

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after another, and how many each id has."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id has no token")
        length = self.lengths[ids]
        return self.bytes[_ranges(self.starts[ids], length)], length

    def code_points(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each token starts and ends in its text, in code points; the end is exclusive."""
        data, length = self.decode(ids)
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points begun before a byte
        ends = np.cumsum(length)
        first_token = np.repeat(np.cumsum(sizes) - sizes, sizes)
        base = begins[(ends - length)[first_token]] if len(ids) else begins[:0]
        inside = (data[ends - length] & 0xC0) == 0x80 if len(ids) else np.zeros(0, bool)
        return begins[ends - length] - inside - base, begins[ends] - base


def encode(docs: DataFrame, ranks: str | None = None, offsets: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of whole texts; with offsets also ``starts`` and ``ends`` of all tokens."""
    path = ranks or default_ranks()

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path)
        for part in chunks(batches, size=BATCH_BYTES):
            ids, sizes = bpe.encode([t or "" for t in column(part, "text").to_pylist()])
            columns = [column(part, "doc_id"), pa.array(sizes), lists(ids, sizes, pa.int32())]
            names = ["doc_id", "n_tokens", "ids"]
            if offsets:
                columns += [lists(at.astype(np.int32), sizes, pa.int32()) for at in bpe.code_points(ids, sizes)]
                names += ["starts", "ends"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ENCODED + (", starts array<int>, ends array<int>" if offsets else "")
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), to_ids, schema)


def _id_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the ids of each piece stay near ``size``, one longer list aside."""
    for batch in batches:
        counts = column(batch, "ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(counts.astype(np.int64)), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def decode(rows: DataFrame, ranks: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``data``, the bytes of ``ids``, with ``head`` and ``tail``: its bytes of unfinished characters.

    ``head`` counts leading bytes that continue a character, ``tail`` trailing bytes of one whose
    end is missing. Whole texts have neither.
    """
    path = ranks or default_ranks()

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path)
        for batch in _id_batches(batches, BATCH_BYTES):
            held = column(batch, "ids")
            sizes = held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = held.flatten()
            if flat.null_count:
                raise ValueError("a list holds a null id")
            data, length = bpe.decode(flat.to_numpy(zero_copy_only=False))
            bounds = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(sizes)])]
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    *[column(batch, c) for c in keep],
                    pa.array(texts, pa.binary()),
                    pa.array([_head(t) for t in texts], pa.int32()),
                    pa.array([_tail(t) for t in texts], pa.int32()),
                ],
                names=[*keep, "data", "head", "tail"],
            )

    kept = rows.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return arrow_map(rows.select(*keep, "ids"), to_bytes, schema + ", data binary, head int, tail int")


def _head(data: bytes) -> int:
    n = 0
    while n < min(3, len(data)) and data[n] & 0xC0 == 0x80:
        n += 1
    return n


def _tail(data: bytes) -> int:
    for back in range(1, min(4, len(data)) + 1):
        byte = data[-back]
        if byte & 0xC0 != 0x80:
            width = 1 if byte < 0xC0 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            return back if width > back else 0
    return 0


def join_pieces(pieces: DataFrame) -> DataFrame:
    """(doc_id, text) from decoded pieces (doc_id, start, data) of documents, in order of ``start``.

    Bytes are put together before they become text, so characters over borders stay whole. What
    one group holds is one document.
    """
    ordered = F.array_sort(F.collect_list(F.struct("start", "data")))
    return pieces.groupBy("doc_id").agg(ordered.alias("_p")).select(
        "doc_id", F.decode(F.aggregate("_p", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["data"])), "UTF-8").alias("text")
    )


def ids_digest(ids: str = "ids") -> Column:
    """The sha256 of the ids as decimals, joined by single spaces."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
