"""Whole texts to token ids with a public tokenizer, words being encoded once each.

The tokenizer at hand drops white space and never joins across it, so a text's ids are the ids
of its words in order. Words are found and counted by Arrow, and only words that a task has not
met are encoded. A full stop or comma after a letter ends a word, as it does in the tokenizer. A text that may hold one of the tokenizer's special strings is encoded whole.
"""

from __future__ import annotations

import os
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 1
CACHED_WORDS = 800_000  # words whose ids a worker remembers before it forgets the later half


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Encodes batches of texts; keeps the ids of words seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.lower() for t in added]
        self.known = pa.array([], pa.large_string())  # their ids lie in ``flat``, between ``bounds``
        self.flat = np.zeros(1 << 20, np.int32)
        self.bounds = np.zeros(1 << 16, np.int64)

    @classmethod
    def shared(cls, path: str) -> WordEncoder:
        """One encoder for all tasks of a Python worker."""
        held = sys.modules[__name__].__dict__.setdefault("_ENCODERS", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _learn(self, words: pa.Array) -> None:
        count = len(self.known)
        fresh = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        ids = [e.ids for e in fresh]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        at, end = self.bounds[count], count + len(ids)
        while end + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.bounds[count + 1 : end + 1] = at + np.cumsum(sizes)
        total = int(sizes.sum())
        while at + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at : at + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.known = pa.concat_arrays([self.known, words])

    def _places(self, words: pa.Array) -> np.ndarray:
        """The place of each of these different words among the known ones; new ones are learned."""
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = self.known.slice(0, CACHED_WORDS // 2)  # words met first are met most
        place = pc.index_in(words, value_set=self.known)
        new = words.filter(place.is_null())
        out = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        if len(new):
            out[out < 0] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(new)
        return out

    def encode(self, texts: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text; null counts as empty."""
        plain = pc.fill_null(texts.cast(pa.large_string()), "")
        lower = pc.ascii_lower(plain)
        odd = np.zeros(len(plain), bool)
        for s in self.special:
            odd |= pc.match_substring(lower, s).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(odd)
        if len(whole):
            lower = pc.if_else(pa.array(odd), "", lower)
        apart = pc.replace_substring_regex(lower, r"([a-z])([.,;:!?])", r"\1 \2")
        split = pc.ascii_split_whitespace(apart)
        n_words = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        words = pc.list_flatten(split)
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary)
        at = place[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        begin = self.bounds[at]
        length = self.bounds[at + 1] - begin
        ids = self.flat[_ranges(begin, length)]
        ends = np.concatenate([[0], np.cumsum(length)])
        word_end = np.cumsum(n_words)
        sizes = np.diff(ends[np.concatenate([[0], word_end])])
        if len(whole) or end_id is not None:
            ids, sizes = self._finish(plain, whole, ids, sizes, end_id)
        return ids, sizes

    def _finish(self, plain, whole, ids, sizes, end_id):
        tail = 0 if end_id is None else 1
        extra = {}
        for i in whole:
            extra[i] = self.tokenizer.encode(plain[int(i)].as_py(), add_special_tokens=False).ids
        total = sizes + tail
        for i, x in extra.items():
            total[i] += len(x)
        out = np.full(int(total.sum()), END_ID if end_id is None else end_id, np.int32)
        begin = np.cumsum(total) - total
        out[_ranges(begin, sizes)] = ids
        for i, x in extra.items():
            out[begin[i] : begin[i] + len(x)] = x
        return out, total


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions begin[i] .. begin[i] + length[i] - 1 of all i, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - length), length)
