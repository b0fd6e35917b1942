"""Quality classifier: a linear support vector machine on naive Bayes scaled n-gram indicators.

A text's features are the different byte n-grams and word-shape n-grams that it holds, hashed to
a fixed number of slots, and one that all have. A word's shape is the kinds of its first and last
byte, its length on a log scale, and whether it repeats the word before it.
Each indicator is scaled by the log ratio of its smoothed shares in the two classes, texts are
brought to a common length, and a hinge loss is minimised by dual coordinate descent. A part of
the labelled rows is kept out of that to turn margins into probabilities.

The fit uses a bounded sample of labelled rows: at most ``MOST_LABELLED``, chosen by hashing the
document id, so that it does not depend on the order of rows. Their features reach the driver as
slots or, where that is shorter, as a bitmap of all slots: 32 KB a row at most, 400 MB in all,
however long the texts are. Scoring covers every whole text.

Nulls and repeats: a null or empty text has only the feature that all texts have; a null label or id is no label; a document labelled more than once counts once, with the
mean label, 1 from a half on. Without both classes among the labels the score is the share of
label 1 (a half without labels). Repeated rows are scored each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import SubstringHash, arrow_map, chunks, column, joined_bytes, words_of

SLOT_BITS = 18
GRAMS = (2, 3)  # lengths of n-grams in bytes
SHAPES = (1, 2, 3)  # lengths of n-grams of word shapes
MOST_LABELLED = 12_000
ROUNDS = 12
BITMAP_BYTES = (1 << SLOT_BITS) // 8
COST = 1.0


_KIND = np.full(256, 5, np.uint32)  # of bytes: control, letters, digits, other marks, beyond ASCII
_KIND[:33], _KIND[128:] = 0, 4
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3


def _slots(codes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """The slot of the n-gram of codes at each position."""
    code = np.full(max(0, len(codes) - n + 1), n + salt, np.uint32)
    for k in range(n):
        code = code * np.uint32(65599) + codes[k : len(codes) - n + 1 + k]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (code ^ (code >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(32 - SLOT_BITS)


def _shapes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shape of every word and where words end."""
    starts, ends = words_of(data)
    hashes = SubstringHash(data).of(starts, ends)
    again = np.zeros(len(starts), np.uint32)
    again[1:] = hashes[1:] == hashes[:-1]
    size = np.minimum(np.log2(np.maximum(1, ends - starts)), 7).astype(np.uint32)
    return ((_KIND[data[starts]] * 6 + _KIND[data[ends - 1]]) * 8 + size) * 2 + again, ends


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The slots of the different n-grams of each text."""
    data, bounds = joined_bytes(texts)
    byte_slots = [_slots(data.astype(np.uint32), n, 0) for n in GRAMS]
    shapes, ends = _shapes(data)
    shape_slots = [_slots(shapes, n, 100) for n in SHAPES]
    words = np.searchsorted(ends, bounds, side="right")
    seen = np.zeros(1 << SLOT_BITS, bool)
    for i in range(len(bounds) - 1):
        seen[0] = True
        for n, at in zip(GRAMS, byte_slots):
            seen[at[bounds[i] : max(bounds[i], bounds[i + 1] - n)]] = True
        for n, at in zip(SHAPES, shape_slots):
            seen[at[words[i] : max(words[i], words[i + 1] - n + 1)]] = True
        held = np.flatnonzero(seen)
        seen[held] = False
        yield held


def packed(held: np.ndarray) -> bytes:
    """Slots as numbers of four bytes, or as a bitmap where that is no longer."""
    if 4 * len(held) < BITMAP_BYTES:
        return held.astype("<i4").tobytes()
    bits = np.zeros(1 << SLOT_BITS, bool)
    bits[held] = True
    return np.packbits(bits).tobytes()


class PackedRows(Sequence):
    """Rows of slots that stay packed until they are used."""

    def __init__(self, raw: Sequence[bytes]):
        self.raw = raw

    def __len__(self) -> int:
        return len(self.raw)

    def __getitem__(self, i: int) -> np.ndarray:
        raw = self.raw[i]
        if len(raw) < BITMAP_BYTES:
            return np.frombuffer(raw, "<i4")
        return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8)))

    def some(self, chosen: np.ndarray) -> PackedRows:
        return PackedRows([raw for raw, c in zip(self.raw, chosen) if c])


@dataclass
class QualityModel:
    weights: np.ndarray
    slope: float
    shift: float

    def margin(self, held: np.ndarray) -> float:
        return float(self.weights[held].sum() / np.sqrt(max(1, len(held))))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def log_count_ratios(rows: Sequence[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each slot in the classes 1 and 0."""
    counts = np.ones((2, 1 << SLOT_BITS))
    for held, y in zip(rows, labels):
        counts[y, held] += 1
    shares = counts / (np.bincount(labels, minlength=2)[:, None] + 2.0)
    return np.log(shares[1]) - np.log(shares[0])


def dual_coordinate_descent(
    rows: Sequence[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: float, rounds: int
) -> np.ndarray:
    """Weights of the hinge loss with an L2 penalty; row i holds scale[rows[i]] / sqrt(len)."""
    weights = np.zeros(len(scale))

    def values(held: np.ndarray) -> np.ndarray:
        return scale[held] / np.sqrt(max(1, len(held)))

    norms = np.array([float(v @ v) for v in map(values, rows)])
    alphas = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        largest = 0.0
        for i in order.permutation(len(rows)):
            if norms[i] == 0:
                continue
            held = rows[i]
            value = values(held)
            slack = signs[i] * float(weights[held] @ value) - 1.0
            new = min(max(alphas[i] - slack / norms[i], 0.0), cost)
            if new != alphas[i]:
                weights[held] += (new - alphas[i]) * signs[i] * value
                largest = max(largest, abs(new - alphas[i]))
                alphas[i] = new
        if largest < 1e-3 * cost:
            break
    return weights * scale


def _logistic_line(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton's method."""
    hits, misses = labels.sum(), len(labels) - labels.sum()
    goal = np.where(labels == 1, (hits + 1) / (hits + 2), 1 / (misses + 2))
    x = np.column_stack([margins, np.ones_like(margins)])
    line = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (goal - p) - 1e-6 * line
        )
        line += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(line[0]), float(line[1])


def fit_rows(rows: PackedRows, labels: np.ndarray) -> QualityModel:
    """Fit on the features and labels of the sample; every fourth row sets the probabilities."""
    labels = labels.astype(int)
    aside = np.arange(len(rows)) % 4 == 3
    train = rows.some(~aside)
    if len(set(labels[~aside])) < 2 or len(set(labels[aside])) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return QualityModel(np.zeros(1 << SLOT_BITS), 0.0, float(np.log(share / (1 - share))))
    ratios = log_count_ratios(train, labels[~aside])
    weights = dual_coordinate_descent(train, 2 * labels[~aside] - 1, ratios, COST, ROUNDS)
    model = QualityModel(weights, 1.0, 0.0)
    margins = np.array([model.margin(r) for r in rows.some(aside)])
    model.slope, model.shift = _logistic_line(margins, labels[aside])
    return model


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels no fit may see: one id in five, by checksum."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, label, slots) of at most ``most`` labelled documents outside the held-out part.

    The chosen ids are few enough to be sent to every task, so no text goes through an exchange
    but those of the sample, where repeated ids are brought down to one row.
    """
    known = labels.filter(~held_out("doc_id")).select("doc_id", F.col("quality").cast("double").alias("q"))
    known = known.dropna().groupBy("doc_id").agg((F.avg("q") >= 0.5).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            slots = pa.array([packed(h) for h in features(column(part, "text"))], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), column(part, "label"), slots], names=["doc_id", "label", "slots"]
            )

    return arrow_map(found, extract, "doc_id long, label int, slots binary")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> QualityModel:
    """Fit on the driver, from the bounded sample."""
    sample = sorted(labelled_sample(docs, labels, most).collect(), key=lambda r: r["doc_id"])
    rng = np.random.default_rng(11)
    order = rng.permutation(len(sample))
    rows = PackedRows([bytes(sample[i]["slots"]) for i in order])
    return fit_rows(rows, np.array([sample[i]["label"] for i in order], int))


def score(docs: DataFrame, model: QualityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``score``, the probability of label 1, for every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            margins = np.array([model.margin(h) for h in features(column(part, "text"))])
            columns = [column(part, c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(model.probability(margins))], names=[*keep, "score"]
            )

    needed = docs.select(*dict.fromkeys([*keep, "text"]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return arrow_map(needed, rate, ", ".join([*fields, "score double"]))
