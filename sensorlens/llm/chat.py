"""Chat formatting in budgeted windows.

A turn is written as ``<s>role[INST]text</s>``. Wherever a role or text holds one of the control
strings, a backslash goes in behind its first character; backslashes are doubled, so escaping is
undone by dropping every backslash that stands before another character.

A turn counts as the tokens that the given tokenizer makes of it as written, control strings
included, one at least; written one behind another turns never make more. A window takes new
turns while they, the system turn and the repeated history stay within the budget. Every later
window begins with the system turn and the last turns before its new ones, as many whole ones as
``history`` and the first new turn allow; both ends are searched in prefix sums of the counts. Only texts of the assistant that are new in a window are under its loss
mask, so each is a target exactly once. A turn that exceeds the budget alone or with the system
turn gets a window of its own, whole and without history.

Turns are numbered by their place in the conversation and worked on in blocks of ``BLOCK`` of
them, so a conversation that holds a third of all rows is spread over many groups, none of them
long. A block knows the turns before and behind it that its windows may reach, which follows from
the smallest turn of all. Where its first
window begins depends on the block before: each block says where its last window would end for
every place where its first may begin, and going through these says where they all begin. So
windows are those of a conversation read from its first turn to its last.

Nulls and repeats: a null text or role is empty; turns are ordered by turn, null first, then by role
and text (the first ``SORTED`` characters of each, then a hash, so that sort keys stay small);
repeated rows are turns of their own; rows without a conversation id are one conversation. An empty table gives no window. Other columns do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlens.llm.common import arrow_map, chunks, column, spread
from sensorlens.llm.tables import written
from sensorlens.llm.token_ids import WordEncoder, default_tokenizer

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BUDGET, HISTORY = 256, 128  # tokens
SORTED = 64  # characters of role and text that sort turns of one number
BLOCK = 1024
ENTRY, SYSTEM, CARRIED, NEW, AHEAD = range(5)

WINDOW = (
    "conv_id long, block long, window int, formatted string, first_new int, n_new int, "
    "mask_starts array<int>, mask_ends array<int>, tokens long"
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for c in CONTROL:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn of a window."""
    return [
        tuple(unescape(part) for part in turn.split("[INST]"))
        for turn in formatted.removeprefix("<s>").removesuffix("</s>").split("</s><s>")
        if formatted
    ]


def _written(role: str, text: str) -> str:
    return f"<s>{escape(role)}[INST]{escape(text)}</s>"


class _Block:
    """The turns of one block of a conversation, those around it included, and its windows."""

    def __init__(self, conv_id: int | None, block: int, budget: int, history: int):
        self.conv_id, self.block, self.budget, self.history = conv_id, block, budget, history
        self.system: tuple | None = None  # the turn that opens the conversation, in an earlier block
        self.turns: list[tuple] = []
        self.sums = [0]  # tokens of the turns before each, and of all
        self.start = self.entry = self.own = 0

    def add(self, kind: int, role: str, text: str | None, tokens: int) -> None:
        if kind == ENTRY:
            self.entry = tokens
        elif kind == SYSTEM:
            self.system = (role, text, tokens)
        else:
            self.turns.append((role, text, tokens))
            self.sums.append(self.sums[-1] + tokens)
            self.start += kind == CARRIED
            self.own += kind == NEW

    def _opened(self) -> bool:
        return self.block == 0 and self.turns[0][0] == "system"

    def _cut(self, at: int) -> tuple[tuple | None, int, int]:
        """System turn, begin of the history and end of the window whose first new turn is ``at``."""
        opened = self._opened()
        system = self.turns[0] if opened and at else self.system
        sums = self.sums
        left = self.budget - self.turns[at][2] - (system[2] if system else 0)
        room = min(self.history, left)
        begin = bisect_left(sums, sums[at] - room, opened, at) if at > opened else at
        left -= sums[at] - sums[begin]
        end = bisect_right(sums, sums[at + 1] + left, at + 1) - 1 if left > 0 else at + 1
        return system, begin, end

    def exits(self, entries: int) -> list[int]:
        """Where in the next block its first window begins, for each place where this block's may."""
        stop = self.start + self.own
        out = list(range(len(self.turns) + 1))
        for i in range(stop - 1, self.start - 1, -1):
            out[i] = out[self._cut(i)[2]]
        return [max(0, out[min(self.start + i, stop)] - stop) for i in range(entries)]

    def windows(self) -> Iterator[tuple]:
        at, count, stop = self.start + self.entry, 0, self.start + self.own
        while at < stop:
            system, begin, end = self._cut(at)
            repeated = ([system] if system else []) + self.turns[begin:at]
            parts, starts, ends, place = [], [], [], 0
            shown = repeated + self.turns[at:end]
            for i, (role, text, _) in enumerate(shown):
                parts.append(_written(role, text))
                if i >= len(repeated) and role == "assistant":
                    starts.append(place + len(f"<s>{escape(role)}[INST]"))
                    ends.append(place + len(parts[-1]) - len("</s>"))
                place += len(parts[-1])
            yield (
                self.conv_id, self.block, count, "".join(parts), len(repeated), end - at,
                starts, ends, sum(t[2] for t in shown),
            )
            at, count = end, count + 1


def numbered(turns: DataFrame, tokenizer: str) -> tuple[DataFrame, int]:
    """(conv_id, role, text, tokens, position) of every turn, and the tokens of the smallest one.

    Positions of a conversation are dense.

    Rows are put in order over all partitions and numbered in each; a partition adds the turns that
    its first conversation has in earlier ones.
    """
    plain = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range borders pass through the driver: no whole text is part of them
    order = ["conv_id", "turn", F.left("role", F.lit(SORTED)), F.left("text", F.lit(SORTED)), F.xxhash64("role", "text")]
    ordered = plain.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(tokenizer)
        conv, place = None, 0
        for part in chunks(batches):
            ids, roles, texts = (column(part, c) for c in ("conv_id", "role", "text"))
            whole = [_written(r, t) for r, t in zip(roles.to_pylist(), texts.to_pylist())]
            sizes = np.maximum(1, encoder.encode(pa.array(whole, pa.string()), None)[1])
            places = []
            for c in ids.to_pylist():
                place = place + 1 if conv == (c,) else 0
                conv = (c,)
                places.append(place)
            yield pa.RecordBatch.from_arrays(
                [ids, roles, texts, pa.array(sizes, pa.int64()), pa.array(places, pa.int64())],
                names=["conv_id", "role", "text", "tokens", "place"],
            )

    counted = arrow_map(ordered, count, "conv_id long, role string, text string, tokens long, place long")
    rows = written(counted.withColumn("part", F.spark_partition_id()), "turns")
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one conversation of a partition began in an earlier one
    begun = sizes.withColumn("before", F.sum("n").over(earlier)).filter("before is not null")
    begun = begun.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "before")
    joined = rows.join(F.broadcast(begun), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")), "left")
    position = F.col("place") + F.coalesce("before", F.lit(0))
    least = rows.agg(F.min("tokens")).first()[0] or 1
    return joined.select("conv_id", "role", "text", "tokens", position.alias("position")), least


def _placed(rows: DataFrame, size: int, tail: int, ahead: int) -> DataFrame:
    """Turns with their block, once more for blocks whose windows reach them."""
    place = F.pmod("position", F.lit(size))
    plain = rows.withColumns({"block": F.floor(F.col("position") / size), "kind": F.lit(NEW)})
    opening = (F.col("position") == 0) & (F.col("role") == "system")
    # the system turn is retained as such and not as history
    tails = plain.filter((place >= size - tail) & ~opening).withColumns({"block": F.col("block") + 1, "kind": F.lit(CARRIED)})
    heads = plain.filter((place < ahead) & (F.col("block") > 0)).withColumns({"block": F.col("block") - 1, "kind": F.lit(AHEAD)})
    later = plain.filter((place == 0) & (F.col("block") > 0)).select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"))
    systems = plain.filter(opening).join(later, F.col("conv_id").eqNullSafe(F.col("_conv")))
    systems = systems.withColumns({"block": F.col("_block"), "kind": F.lit(SYSTEM)}).select(*plain.columns)
    return plain.unionByName(tails).unionByName(heads).unionByName(systems)


def _entries(placed: DataFrame, budget: int, history: int, entries: int) -> DataFrame:
    """(conv_id, block, entry): where the first windows of later blocks begin."""

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _blocks(batches, budget, history):
            rows = [(b.conv_id, b.block, b.exits(entries)) for b in found if b.own]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            columns = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "block", "exits"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, entry = None, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                entry = entry if conv == (r["conv_id"],) else 0
                conv = (r["conv_id"],)
                out.append(entry)
                entry = r["exits"][entry]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "conv_id"), column(batch, "block"), pa.array(out, pa.int64())], names=["conv_id", "block", "entry"]
            )

    long = placed.filter((F.col("block") > 0) & (F.col("kind") == NEW)).select(F.col("conv_id").alias("_conv")).distinct()
    rows = placed.drop("text").withColumn("text", F.lit(None).cast("string"))
    rows = rows.join(long, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    left = arrow_map(_in_order(rows), leave, "conv_id long, block long, exits array<long>")
    ordered = spread(left, ("conv_id",)).sortWithinPartitions("conv_id", "block")
    return arrow_map(ordered, follow, "conv_id long, block long, entry long")


def _in_order(placed: DataFrame) -> DataFrame:
    return spread(placed, ("conv_id", "block")).sortWithinPartitions("conv_id", "block", "kind", "position")


def _blocks(batches: Iterator[pa.RecordBatch], budget: int, history: int) -> Iterator[list[_Block]]:
    """The blocks of a partition, those that end in a batch together."""
    held: _Block | None = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if held is None or (held.conv_id, held.block) != (r["conv_id"], r["block"]):
                out += [held] if held else []
                held = _Block(r["conv_id"], r["block"], budget, history)
            held.add(r["kind"], r["role"], r["text"], r["tokens"])
        yield out
    yield [held] if held else []


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer: str | None = None) -> DataFrame:
    """The windows of all conversations: text, loss mask as spans of code points, what is new."""
    plain, least = numbered(turns, tokenizer or default_tokenizer())
    tail, ahead = history // least + 1, budget // least + 1
    size = max(BLOCK, 2 * tail, 2 * ahead)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()),
                ("first_new", pa.int32()), ("n_new", pa.int32()), ("mask_starts", pa.list_(pa.int32())),
                ("mask_ends", pa.list_(pa.int32())), ("tokens", pa.int64()),
            ]
        )
        for found in _blocks(batches, budget, history):
            rows = [w for b in found for w in b.windows()]
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    placed = _placed(plain, size, tail, ahead)
    entries = _entries(placed, budget, history, ahead + 1).select(
        "conv_id", F.lit("").alias("role"), F.lit("").alias("text"), F.col("entry").alias("tokens"),
        F.lit(0).cast("long").alias("position"), "block", F.lit(ENTRY).alias("kind"),
    )
    return arrow_map(_in_order(placed.unionByName(entries)), run, WINDOW)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation what its windows hold: turns, targets and length, digests included.

    Windows of a conversation are read in order, one at a time; a digest is a running one.
    """
    import hashlib

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, None

        def row() -> tuple:
            return (conv[0], held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if conv is None or conv[0] != r["conv_id"]:
                    out += [row()] if conv else []
                    conv, held = (r["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(r["formatted"])[r["first_new"] :]:
                    held[0] += 1
                    held[1].update(f"{role}\n{text}\n".encode())
                for a, b in zip(r["mask_starts"], r["mask_ends"]):
                    text = unescape(r["formatted"][a:b])
                    held[2] += len(text)
                    held[3].update(text.encode())
                held[4] += len(r["formatted"])
            yield batch_of(out)
        yield batch_of([row()] if conv else [])

    ordered = spread(windows, ("conv_id",)).sortWithinPartitions("conv_id", "block", "window")
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return arrow_map(ordered, read, schema)
