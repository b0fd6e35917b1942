"""Spelling variants: words at one edit from each other, through an index of variable-length grams.

The gram dictionary is pruned by frequency: a gram is a single prefix of longer ones only where it
is frequent among the words, so a rare gram ends early and a frequent one grows until it is rare or
has the longest length. From every place of a word, its ends marked, starts one gram: the dictionary
is walked from there until a gram is not frequent. Whether a gram is taken depends on its own
characters alone, so an edit affects just the grams that hold the edited place; the most that any
one place affects, ``affected``, is counted per word. Of two words at one edit, all but that many grams
of either are common, at the same distance from the start (before the edit) or from the end (behind it).

Lists are merged by a prefix: ordered by rarity, the first ``affected + 1`` grams of both words hold
a common one. Only these are posted, with their place from the start and from the end. How long grams
grow depends on the word's length, so words are posted once for pairs with words of their length or one
more, and once for pairs with words one shorter. Words that share a posting meet in an equi-join; a mask of letters
held an odd number of times drops pairs that differ in more than two, and the distance itself decides.

The frequent grams are the only thing that is broadcast. A threshold that grows with the number of
grams keeps them fewer than ``MOST_FREQUENT`` whatever the input.

Words are maximal runs of the letters given; only A to Z are lower-cased. The operators take any frame of words and counts.
Nulls and repeats: a null text has no words; a null document id counts as empty text where ids
matter; repeated documents count again; ties go to the smaller word in code-point order. Empty in, empty out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, chunks, column
from sensorlens.llm.tables import release, written

SHORTEST_GRAM, LONGEST_GRAM = 2, 6
MOST_FREQUENT = 20_000  # frequent grams at most, all lengths together
LEAST_FREQUENCY = 20  # grams of fewer places are not worth extending
HELD_WORDS = 400_000  # words a task counts before it hands them on
START, END = "\x02", "\x03"
LETTERS = "A-Za-zÀ-ÿ"


def word_counts(docs: DataFrame, letters: str = LETTERS, dropped: int | None = None) -> DataFrame:
    """(word, n): how often each word occurs in whole texts.

    With ``dropped``, an occurrence whose crc32 of ``<doc_id>:<word>`` that number divides is read as
    the word without the code point at crc32 % length: made-up typing errors, alike in every run.
    """
    other = f"[^{letters}]+"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for part in chunks(batches):
            for word, n in _counted(part, other, dropped):
                held[word] += n
            if len(held) > HELD_WORDS:
                yield _count_batch(held)
                held = Counter()
        if held:
            yield _count_batch(held)

    counted = arrow_map(docs.select(F.col("doc_id").cast("string"), "text"), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _count_batch(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
    )


def _counted(part: pa.RecordBatch, other: str, dropped: int | None) -> Iterator[tuple[str, int]]:
    texts = pc.fill_null(column(part, "text").cast(pa.large_string()), "")
    runs = pc.replace_substring_regex(pc.ascii_lower(texts), other, " ")
    split = pc.split_pattern(runs, " ")
    coded = pc.list_flatten(split).dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.bincount(codes, minlength=len(words))
    if dropped is not None and len(words):
        rows = pc.list_parent_indices(split).to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, times = np.unique(rows * len(words) + codes, return_counts=True)
        row, code = np.divmod(pairs, len(words))
        prefixes = [zlib.crc32(f"{i or ''}:".encode()) for i in column(part, "doc_id").to_pylist()]
        raw = [w.encode() for w in words]
        digests = np.fromiter(
            (zlib.crc32(raw[c], prefixes[r]) for r, c in zip(row.tolist(), code.tolist())), np.int64, len(pairs)
        )
        hit = np.flatnonzero(digests % dropped == 0)
        np.subtract.at(counts, code[hit], times[hit])
        for c, h, n in zip(code[hit].tolist(), digests[hit].tolist(), times[hit].tolist()):
            if len(word := words[c]) > 1:
                at = h % len(word)
                yield word[:at] + word[at + 1 :], n
    for word, n in zip(words, counts.tolist()):
        if n and word:
            yield word, n


def longest_for(length: int) -> int:
    """The longest gram in words of a length: short enough that one edit always leaves a gram."""
    return min(LONGEST_GRAM, (length + 3) // 2)


def frequent_grams(words: DataFrame, most: int = MOST_FREQUENT, least: int = LEAST_FREQUENCY) -> dict[str, int]:
    """The grams that more places hold than the threshold, with their number of places.

    A word of L code points has less than 5 * (L + 2) grams of 2 to 6, so at most ``most``
    of them can have more places than the sum of these over ``most``.
    """
    lengths = range(SHORTEST_GRAM, LONGEST_GRAM + 1)
    places = words.agg(F.sum((F.length("word") + 2) * len(lengths))).first()[0] or 0
    threshold = max(least, places // most)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for word in column(batch, "word").to_pylist():
                marked = START + word + END
                held.update(marked[i : i + q] for q in lengths for i in range(len(marked) - q + 1))
                if len(held) > HELD_WORDS:
                    yield _count_batch(held)
                    held.clear()
        if held:
            yield _count_batch(held)

    counted = arrow_map(words.select("word"), count, "word string, n long")
    grams = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > threshold)
    return {r["word"]: r["n"] for r in grams.collect()}


def decompose(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int, str]]:
    """(start, end, gram) from every place of the marked word: extended while frequent."""
    marked = START + word + END
    out = []
    for i in range(len(marked) - 1):
        end = i + SHORTEST_GRAM
        while end < len(marked) and end - i < longest and marked[i:end] in frequent:
            end += 1
        out.append((i, end, marked[i:end]))
    return out


def affected(grams: list[tuple[int, int, str]], length: int) -> int:
    """The most grams that hold one place of the word, its end marks aside."""
    change = [0] * (length + 3)
    for start, end, _ in grams:
        change[start] += 1
        change[end] -= 1
    most = held = 0
    for place in range(length + 1):
        held += change[place]
        if place:
            most = max(most, held)
    return most


def posted(word: str, longest: int, frequent: dict[str, int]) -> list[tuple[int, int, str]]:
    """The rarest grams, one more than an edit can affect, as (place from the start, from the end, gram)."""
    grams = decompose(word, longest, frequent)
    if len(word) < 3:
        raise ValueError(f"{word!r} has fewer than three code points")
    bound = affected(grams, len(word))
    if bound >= len(grams):
        raise ValueError(f"an edit can affect all grams of {word!r}")
    first = sorted(grams, key=lambda g: (frequent.get(g[2], 0), g[2], g[0]))[: bound + 1]
    return [(start, len(word) + 2 - end, gram) for start, end, gram in first]


def letter_mask(word: str) -> int:
    mask = 0
    for c in word:
        mask ^= 1 << (ord(c) % 61)
    return mask


POSTINGS = "side int, place int, class int, gram string, word string, n long, mask long"


def postings(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """A row per posted gram of a word, its place from either side and its class of pair lengths."""
    held = words.sparkSession.sparkContext.broadcast(frequent)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 2_000):
                part = batch.slice(begin, 2_000)
                rows = []
                for word, n in zip(column(part, "word").to_pylist(), column(part, "n").to_pylist()):
                    mask = letter_mask(word)
                    for kind in {len(word), max(SHORTEST_GRAM + 1, len(word) - 1)}:
                        for start, end, gram in posted(word, longest_for(kind), known):
                            rows.append((0, start, kind, gram, word, n, mask))
                            rows.append((1, end, kind, gram, word, n, mask))
                if rows:
                    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["side", "place", "class", "gram", "word", "n", "mask"],
                    )

    return arrow_map(words.select("word", "n"), post, POSTINGS)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): words at exactly one inserted, deleted or replaced code point, a the shorter or smaller.

    ``words`` has (word, n), each word once and of three code points at least; a word of fewer
    cannot be posted for a pair with a shorter one and is refused.
    """
    index = written(postings(words, frequent_grams(words)), "postings")
    key = ["side", "place", "class", "gram"]
    a = index.filter(F.length("word") == F.col("class")).select(
        *key, F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("mask").alias("mask_a")
    )
    b = index.select(*key, F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("mask").alias("mask_b"))
    alike = F.bit_count(F.col("mask_a").bitwiseXOR(F.col("mask_b"))) <= 2
    ordered = (F.length("b") > F.length("a")) | (F.col("a") < F.col("b"))
    met = a.join(b, key).filter(alike & ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "n_a", "n_b").distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, form, form_n, n_near): the most frequent near word, where it is ``ratio`` times as frequent."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"), F.count("*").alias("n_near")
    )
    wins = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.when(wins, F.col("best.near")).alias("form"),
        F.when(wins, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of all words with a form: the last of the forms that follow each other.

    A form is more frequent than its word, so forms never run in a circle. Each round doubles how far
    a word looks ahead, until none has anything ahead of it; a round is written down.
    """
    ahead = written(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = written(
            ahead.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        release(ahead)
        ahead = more.select("word", "root")
        if not more.filter("moved").limit(1).count():
            return ahead


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, form, root, form_n, n_near) of all words, as of :func:`near_pairs`."""
    kept = written(words.select("word", "n"), "words")
    found = written(forms(kept, near_pairs(kept), ratio), "forms")
    release(kept)
    rooted = found.join(roots(found), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))
