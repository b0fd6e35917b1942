"""Set similarity join of whole texts on word n-grams, through signature trees.

1. Every text becomes the set of its hashed word n-grams; texts with equal sets become one set,
   so copies are never compared with each other.
2. N-grams get one order for all sets: by hash, but behind all others those that many sets have
   (they are noted in a table of fixed size by a part of their hash, so a few more may be). Two sets of the wanted similarity must share an n-gram among the first of
   either, so only these are sent out, and n-grams met in a single set are dropped.
3. Near copies come in groups: each set is first compared with a leader, the set that holds the
   most widely shared n-grams. Verified links join sets into groups at once.
4. N-grams that sets of different groups share go into signature trees, one per range of n-grams
   and of bounded size; an n-gram of very many sets is split into blocks that meet two by two.
   Leaves are sets, nodes hold the OR of their leaves' n-gram bitmaps and their range of sizes.
   Pairs of nodes are descended together and dropped when their bitmaps share no bit, when no two sizes fit each other, or
   when both lie in one group of step 3. Leaf pairs are counted n-gram by n-gram, the counts of
   all trees are added up, and pairs whose largest possible overlap is too small are dropped.
5. The rest is verified on whole sets, and links are closed to components.

Steps 2 to 4 only leave out pairs that cannot reach the threshold or are joined already, so the
components are those of all links. Sets are told apart by 64-bit hashes.

Nulls and repeats: a text without words, an empty and a null text have an empty set and are
linked with nothing; a text with fewer words than ``width`` has one n-gram, all its words.
Repeated rows are copies of each other. A null id never names a component that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.common import (
    LOWER, SubstringHash, arrow_map, chunks, column, joined_bytes, lists, mix, signed, spread, words_of,
)
from sensorlens.llm.components import components
from sensorlens.llm.tables import written

CELL_BITS = 22
COMMON = 16
COUNTED = 0.4
COUNT_BUFFER = 4_000_000
FILTER_BITS = 22
FAN_OUT = 8
TREE_ROWS = 200_000  # postings of one tree, those of one block of an n-gram aside
TREE_LISTED = 4_000_000  # and n-grams that its sets list
HOT = 20_000  # sets of one block of an n-gram
BITMAP_WORDS = 16  # 64-bit words of a node's bitmap


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The different hashed word n-grams of each text, ascending."""
    data, bounds = joined_bytes(texts)
    data = LOWER[data]
    starts, ends = words_of(data)
    words = SubstringHash(data).of(starts, ends)
    total = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - width + 1 + k]
    grams = mix(total)
    at = np.searchsorted(ends, bounds, side="right")
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            short = int(b - a)
            for w in words[a:b].tolist():
                short = (short * 0x9E3779B97F4A7C15 + w) % (1 << 64)
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _name(grams: np.ndarray) -> np.int64:
    """The hash of a set."""
    total = np.array([np.add.reduce(mix(grams ^ np.uint64(0xA5A5A5A5))) + np.uint64(len(grams))])
    return signed(mix(total))[0]


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    """First n-grams of a set among which any set of the similarity shares one."""
    return n - (percent * n + 99) // 100 + 1


def index_length(n: int, percent: int) -> int:
    """The same where only sets as large or larger are met."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent) + 1


def named_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, sid, n) of all documents: the hash of the set and its size."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            held = [(_name(g), len(g)) for g in shingle_sets(column(part, "text"), width)]
            sids, sizes = (pa.array(x, pa.int64()) for x in zip(*held))
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), sids, sizes], names=["doc_id", "sid", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, name, "doc_id long, sid long, n long")


def common_cells(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """Marks for n-grams that more than ``COMMON`` sets have; ``2**CELL_BITS`` whatever the input.

    Only the lower part of the hash space can come first in a set, so only there is every n-gram
    counted; above it those are that a task meets more than once in a buffer.
    """
    top = np.uint64(int(COUNTED * 2**64))

    def count(held: list[np.ndarray]) -> pa.RecordBatch:
        grams, times = np.unique(np.concatenate(held), return_counts=True)
        sent = (grams < top) | (times > 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(grams[sent])), pa.array(times[sent].astype(np.int64))], names=["gram", "times"]
        )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held, size = [], 0
        for part in chunks(batches):
            for grams in shingle_sets(column(part, "text"), width):
                if len(grams) and (sid := int(_name(grams))) not in done:
                    done.add(sid)
                    held.append(grams)
                    size += len(grams)
            if size > COUNT_BUFFER:
                yield count(held)
                held, size = [], 0
        if held:
            yield count(held)

    tallied = arrow_map(docs.select("text"), tally, "gram long, times long")
    common = tallied.groupBy("gram").agg(F.sum("times").alias("times")).filter(F.col("times") > COMMON)
    cells = common.select(F.shiftrightunsigned("gram", 64 - CELL_BITS).alias("cell")).distinct()
    marks = np.zeros(1 << CELL_BITS, bool)
    marks[cells.toArrow()["cell"].to_numpy()] = True
    return np.packbits(marks)


def postings(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """(gram, sid, n, h): the first n-grams of each set, its size and how many of it are common.

    Common n-grams have negative numbers; whatever the sign, they come last.
    """

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # one partition's sets
        marks = np.unpackbits(common).astype(np.uint64) << np.uint64(63)
        for part in chunks(batches):
            first, sids, sizes, counts, commons = [], [], [], [], []
            for grams in shingle_sets(column(part, "text"), width):
                n = len(grams)
                if n == 0 or (sid := int(_name(grams))) in done:
                    continue
                done.add(sid)
                order = marks[_cells(grams)] | (grams >> np.uint64(1))
                keep = prefix_length(n, percent)
                least = np.sort(np.partition(order, keep - 1)[:keep]) if keep < n else np.sort(order)
                first.append(least)
                sids.append(sid)
                sizes.append(n)
                counts.append(len(least))
                commons.append(int((order >> np.uint64(63)).sum()))
            if first:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(first))),
                        pa.array(np.repeat(np.array(sids, np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                        pa.array(np.repeat(np.array(commons, np.int32), counts)),
                    ],
                    names=["gram", "sid", "n", "h"],
                )

    return arrow_map(docs.select("text"), post, "gram long, sid long, n int, h int")


def shared_postings(posted: DataFrame) -> DataFrame:
    """Postings of n-grams that two sets have, each posting once.

    A partition is read in order and row by row let through: nothing is gathered.
    """

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row and whether it was sent
        for batch in batches:
            if batch.num_rows == 0:
                continue
            gram, sid, n, h = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("gram", "sid", "n", "h"))
            sent = np.zeros(len(gram), bool)
            if last is not None:
                gram, sid, n, h = (np.concatenate([[x], y]) for x, y in zip(last[0], (gram, sid, n, h)))
                sent = np.concatenate([[last[1]], sent])
            fresh = np.ones(len(gram), bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (sid[1:] != sid[:-1])
            gram, sid, n, h, sent = (x[fresh] for x in (gram, sid, n, h, sent))
            head = np.ones(len(gram), bool)
            head[1:] = gram[1:] != gram[:-1]
            shared = ~head
            shared[:-1] |= ~head[1:]
            if last is not None and last[1]:
                shared[0] = True
            out = np.flatnonzero(shared & ~sent)
            last = (
                (gram[-1], sid[-1], n[-1], h[-1]),
                bool(shared[-1]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram[out]), pa.array(sid[out]), pa.array(n[out].astype(np.int32)),
                    pa.array(h[out].astype(np.int32)),
                ],
                names=["gram", "sid", "n", "h"],
            )

    ordered = posted.repartition("gram").sortWithinPartitions("gram", "sid")
    return arrow_map(ordered, share, "gram long, sid long, n int, h int")


def with_leaders(shared: DataFrame) -> DataFrame:
    """Postings with a leader of each n-gram: the set whose n-grams are shared most.

    Of a group of near copies that is the one most like the others, as a rule what all of them
    were copied from.
    """
    spread_ = shared.groupBy("gram").agg(F.count("*").alias("df"))
    weights = shared.join(spread_, "gram").groupBy("sid").agg(F.sum("df").alias("weight"))
    first = F.max(F.struct("weight", "sid", "n")).alias("first")
    leaders = shared.select("gram", "sid", "n").join(weights, "sid").groupBy("gram").agg(first)
    return shared.join(
        leaders.select("gram", F.col("first.sid").alias("lead"), F.col("first.n").alias("lead_n")), "gram"
    )


def leader_pairs(led: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set with the leader that it shares most n-grams with.

    Only pairs that share a good part of their first n-grams are worth a try; what is not tried
    here is left to the trees.
    """
    small, large = F.least("n", "lead_n"), F.greatest("n", "lead_n")
    fits = (F.col("sid") != F.col("lead")) & (100 * small >= percent * large)
    counted = led.filter(fits).groupBy("sid", "lead").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    counted = counted.filter(200 * F.col("c") >= (100 - percent) * F.col("n"))
    best = counted.groupBy("sid").agg(F.max(F.struct("c", "lead")).alias("best"))
    return best.select(F.col("sid").alias("a"), F.col("best.lead").alias("b"))


class _Tree:
    """Sets of one task as leaves, in the order of their first n-gram, and the nodes above them."""

    def __init__(self, leaves: dict[str, np.ndarray], doc: np.ndarray, gram: np.ndarray, common: bool):
        bits = BITMAP_WORDS * 64
        bit = gram * bits // (int(gram.max()) + 1)
        maps = np.zeros((len(leaves["n"]), BITMAP_WORDS), np.uint64)
        np.bitwise_or.at(maps, (doc, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        self.common = common
        self.levels = [
            {"maps": maps, "least": leaves["n"], "most": leaves["n"], "common": leaves["h"],
             "from": leaves["grp"], "to": leaves["grp"]}
        ]
        over = {"maps": np.bitwise_or, "least": np.minimum, "from": np.minimum}
        while len(self.levels[-1]["maps"]) > FAN_OUT:
            below = self.levels[-1]
            at = np.arange(0, len(below["maps"]), FAN_OUT)
            self.levels.append({k: over.get(k, np.maximum).reduceat(v, at, axis=0) for k, v in below.items()})

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        x = self.levels[level]
        fits = (100 * x["most"][a] >= percent * x["least"][b]) & (100 * x["most"][b] >= percent * x["least"][a])
        fits &= (x["from"][a] != x["to"][a]) | (x["from"][b] != x["to"][b]) | (x["from"][a] != x["from"][b])
        if self.common:  # no other n-gram shared: the common ones must do
            most = np.minimum(x["common"][a], x["common"][b])
            fits &= (100 + percent) * most >= percent * (x["least"][a] + x["least"][b])
        a, b, kept = a[fits], b[fits], np.flatnonzero(fits)
        meet = np.zeros(len(a), bool)
        for w in range(BITMAP_WORDS):
            meet |= (x["maps"][a, w] & x["maps"][b, w]) != 0
        return kept[meet]

    def pairs(self, percent: int, block: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaf pairs a < b that no node has ruled out, in blocks; a stack bounds what is held."""
        top = len(self.levels) - 1
        a, b = np.triu_indices(len(self.levels[top]["maps"]))
        stack = [(top, a, b)]
        i, j = np.divmod(np.arange(FAN_OUT * FAN_OUT), FAN_OUT)
        while stack:
            level, a, b = stack.pop()
            if len(a) > block:
                stack += [(level, a[k : k + block], b[k : k + block]) for k in range(0, len(a), block)]
                continue
            kept = self._possible(level, a, b, percent)
            a, b = a[kept], b[kept]
            if level == 0:
                yield a[a < b], b[a < b]
                continue
            below = len(self.levels[level - 1]["maps"])
            down_a, down_b = (a[:, None] * FAN_OUT + i).ravel(), (b[:, None] * FAN_OUT + j).ravel()
            real = (down_a < below) & (down_b < below) & (down_a <= down_b)
            if real.any():
                stack.append((level - 1, down_a[real], down_b[real]))


class _Members:
    """Members of a number of sets, laid end to end, for counting what pairs of sets share."""

    def __init__(self, members: np.ndarray, heads: np.ndarray, counts: np.ndarray):
        self.members, self.heads, self.counts = members, heads, counts
        self.width = int(members.max()) + 1
        at = np.repeat(np.arange(len(heads)), counts)
        flat = members[np.repeat(heads, counts) + np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)]
        self.keys = np.sort(at * self.width + flat)

    def shared(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many members the sets x and y share, pair by pair, and the first one (0 if none)."""
        counts = self.counts[x]
        owner = np.repeat(np.arange(len(x)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        member = self.members[self.heads[x][owner] + inside]
        wanted = y[owner] * self.width + member
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == wanted)
        first = np.full(len(x), self.width)
        np.minimum.at(first, owner[hit], member[hit])
        return np.bincount(owner[hit], minlength=len(x)), np.where(first == self.width, 0, first)


def _join_in_tree(rows: dict[str, np.ndarray], percent: int, common: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of sets of different groups that share one of these n-grams, and how many they share."""
    kinds, gram = np.unique(rows["gram"], return_inverse=True)
    limits = np.iinfo(np.int64)
    most, least = np.full(len(kinds), limits.min), np.full(len(kinds), limits.max)
    np.maximum.at(most, gram, rows["grp"])
    np.minimum.at(least, gram, rows["grp"])
    mixed = most[gram] != least[gram]  # n-grams of one group alone have done their work
    if not mixed.any():
        return
    whole_lists = rows.pop("all", None)
    rows = {k: v[mixed] for k, v in rows.items()} | {"gram": gram[mixed]}
    order = np.lexsort((rows["gram"], rows["sid"]))
    rows = {k: v[order] for k, v in rows.items()} | {"all": whole_lists}
    sid, gram = rows["sid"], rows["gram"]
    heads = np.flatnonzero(np.concatenate([[True], sid[1:] != sid[:-1]]))
    counts = np.diff(np.concatenate([heads, [len(sid)]]))
    by_first = np.lexsort((rows["n"][heads], gram[heads]))
    place = np.empty(len(heads), np.int64)
    place[by_first] = np.arange(len(heads))
    doc = np.repeat(place, counts)
    heads, counts = heads[by_first], counts[by_first]
    leaves = {k: rows[k][heads].astype(np.int64) for k in ("n", "h", "grp", "sid")}
    tree = _Tree(leaves, doc, gram, common)
    here = _Members(gram, heads, counts)
    if common:
        whole = pc.list_flatten(rows["all"].take(pa.array(rows["row"][heads])))
        sizes = pc.list_value_length(rows["all"].take(pa.array(rows["row"][heads]))).to_numpy()
        names, every = np.unique(whole.to_numpy(), return_inverse=True)
        everywhere = _Members(every, np.cumsum(sizes) - sizes, sizes.astype(np.int64))
        local = np.isin(names, kinds)
        # common n-grams behind the first ones, which the lists do not show
        later = leaves["h"] - (leaves["n"] - (percent * leaves["n"] + 99) // 100 + 1 - (leaves["n"] - leaves["h"]))
    for a, b in tree.pairs(percent):
        for i in range(0, len(a), 20_000):
            x, y = a[i : i + 20_000], b[i : i + 20_000]
            c, first = here.shared(x, y)
            if common:
                x, y = x[c > 0], y[c > 0]
                c, first = everywhere.shared(x, y)
                # the task of the first n-gram that two sets share yields the pair, no other
                own = local[first] & (
                    (100 + percent) * (c + np.maximum(later[x], later[y])) >= percent * (leaves["n"][x] + leaves["n"][y])
                )
                c = np.where(own, c, 0)
            x, y, c = x[c > 0], y[c > 0], c[c > 0]
            swap = leaves["sid"][x] > leaves["sid"][y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            columns = [leaves[k][z] for k in ("sid", "n", "h") for z in (x, y)]
            columns += [np.zeros_like(c) if common else c, np.full(len(c), int(common))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(z.astype(np.int64)) for z in columns],
                names=["a", "b", "a_n", "b_n", "a_h", "b_h", "c", "by_common"],
            )


def tree_pairs(shared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets of different groups that may reach the threshold.

    Pairs that share an n-gram which is not common are found, and counted, by those alone; the
    trees of common ones need only yield pairs that share no other.
    """
    known = roots.withColumnRenamed("node", "sid")
    grouped = shared.join(known, "sid", "left").withColumn("grp", F.coalesce("root", "sid")).drop("root")
    # n-grams of one group alone have done their work
    listing = F.when(F.col("gram") < 0, F.least("h", F.floor((100 - percent) * F.col("n") / 100) + 1))
    met = grouped.groupBy("gram").agg(
        F.min("grp").alias("least"), F.max("grp").alias("most"), F.count("*").alias("df"), F.sum(listing).alias("listed")
    )
    blocks = F.ceil(F.greatest(F.col("df") / HOT, 2 * F.col("listed") / TREE_LISTED)).cast("int").alias("blocks")
    live = written(grouped.join(met.filter("least < most").select("gram", blocks), "gram"), "met")
    commons = live.filter("gram < 0").groupBy("sid").agg(F.collect_list("gram").alias("commons"))
    # every two blocks of an n-gram meet in one place, and each with itself
    block = F.pmod(F.xxhash64("sid", F.lit(5)), "blocks")
    placed = live.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    listed = placed.join(commons, "sid", "left").select(
        "gram", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "sid", "n", "h", "grp",
        F.when(F.col("gram") < 0, F.col("commons")).alias("all"),
    )
    dealt = spread(listed, ("gram", "x", "y")).sortWithinPartitions("gram", "x", "y")

    def join(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("gram", "sid", "n", "h", "grp")
        rows = {c: np.concatenate([column(b, c).to_numpy(zero_copy_only=False) for b in parts]) for c in names}
        rows["row"] = np.arange(len(rows["gram"]))
        lists_ = pa.concat_arrays([column(b, "all") for b in parts])
        for common in (False, True):
            some = (rows["gram"] < 0) == common
            if some.any():
                chosen = {k: v[some] for k, v in rows.items()}
                yield from _join_in_tree(chosen | ({"all": lists_} if common else {}), percent, common)

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, listing, last = 0, 0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = [column(batch, c).to_numpy(zero_copy_only=False) for c in ("gram", "x", "y")]
            lengths = pc.fill_null(pc.list_value_length(column(batch, "all")), 0).to_numpy(zero_copy_only=False)
            head = np.concatenate([[last != tuple(k[0] for k in key)], np.any([k[1:] != k[:-1] for k in key], axis=0)])
            last = tuple(k[-1] for k in key)
            begin = 0
            for at in np.flatnonzero(head):  # a tree ends where the next n-gram, or block of one, begins
                held.append(batch.slice(begin, at - begin))
                size, listing, begin = size + at - begin, listing + int(lengths[begin:at].sum()), at
                if size >= TREE_ROWS or listing >= TREE_LISTED:
                    yield from join(held)
                    held, size, listing = [], 0, 0
            held.append(batch.slice(begin))
            size, listing = size + batch.num_rows - begin, listing + int(lengths[begin:].sum())
        if size:
            yield from join(held)

    schema = "a long, b long, a_n long, b_n long, a_h long, b_h long, c long, by_common long"
    local = arrow_map(dealt, traverse, schema)
    summed = local.groupBy("a", "b", "a_n", "b_n", "a_h", "b_h").agg(
        F.sum("c").alias("c"), F.max("by_common").alias("by_common")
    )
    return summed.filter((F.col("by_common") == 1) | _reachable(percent)).select("a", "b")


def _reachable(percent: int) -> Column:
    """Whether the first n-grams that two sets share and all later ones can reach the threshold.

    Of the set whose first n-grams end earlier, all others may be shared: its size without those
    of its first n-grams that are not common.
    """

    def later(x: str) -> Column:
        n, h = F.col(f"{x}_n"), F.col(f"{x}_h")
        return F.greatest(F.floor((percent * n + 99) / 100) - 1, h)

    most = F.col("c") + F.greatest(later("a"), later("b"))
    return (100 + percent) * most >= percent * (F.col("a_n") + F.col("b_n"))


def whole_sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """(sid, grams) of the sets named in ``wanted``, one row each.

    A filter of fixed size keeps most other sets from being sent; the join leaves no other.
    """
    slot = F.col("sid").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    slots = wanted.select(slot.alias("s")).distinct().toArrow()["s"]
    member = np.zeros(1 << FILTER_BITS, bool)
    member[slots.to_numpy()] = True
    packed = np.packbits(member)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_slots = np.unpackbits(packed).astype(bool)
        done: set[int] = set()
        for part in chunks(batches):
            sids, held = [], []
            for grams in shingle_sets(column(part, "text"), width):
                if len(grams) and open_slots[(sid := int(_name(grams))) & ((1 << FILTER_BITS) - 1)] and sid not in done:
                    done.add(sid)
                    sids.append(sid)
                    held.append(grams)
            if sids:
                flat, counts = np.concatenate(held), np.array([len(g) for g in held])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sids, pa.int64()), lists(signed(flat), counts, pa.int64())], names=["sid", "grams"]
                )

    made = arrow_map(docs.select("text"), extract, "sid long, grams array<long>")
    return made.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("grams").alias("grams"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    a = sets.select(F.col("sid").alias("a"), F.col("grams").alias("a_grams"))
    b = sets.select(F.col("sid").alias("b"), F.col("grams").alias("b_grams"))
    both = F.size(F.array_intersect("a_grams", "b_grams"))
    either = F.size("a_grams") + F.size("b_grams") - both
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * either).select("a", "b")


def _links(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that whole sets confirm, written down."""
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    sets = written(whole_sets(docs, width, ends), "grams")
    return written(verified(pairs, sets, percent), "links")


def link_classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that links reach."""
    named = written(named_sets(docs, width), "sets")
    common = common_cells(docs, width, percent)
    shared = written(shared_postings(postings(docs, width, percent, common)), "postings")
    pairs = written(leader_pairs(with_leaders(shared), percent), "pairs")
    links = _links(docs, pairs, width, percent)
    roots = components(links)
    pairs = written(tree_pairs(shared, roots, percent), "pairs")
    if not pairs.isEmpty():
        roots = components(links.unionByName(_links(docs, pairs, width, percent)))
    keyed = named.join(roots, named["sid"] == roots["node"], "left").select(
        "doc_id", "n", F.coalesce("root", "sid").alias("key")
    )
    least = keyed.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    return keyed.join(least, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
