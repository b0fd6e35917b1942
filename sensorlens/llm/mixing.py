"""Mix sources to target weights, natively.

Every document gets a key drawn by hashing its id and text. Within a source, documents are taken
in key order until the source's budget of words is used up; a budget beyond the source's size
takes whole epochs first. The order is never sorted as a whole: the key space is cut into equal
ranges, words are summed per source and range, the sums of earlier ranges are added up, and only
rows of one range are ordered against each other. Hash keys fill the ranges evenly, so a source
with a third of all rows is spread like any other.

Targets: sources, ordered by code point with null last, weigh ``weights`` in turn and share
``share`` times all words. A target stops at ``cap`` times its source's size; what is over goes
to the other sources by weight. In order of size over weight the capped sources come first, so
running sums give the final level in one step. This needs one row per source in one task.

Nulls and repeats: a null text has no words; null is a source of its own; a null id is a value
like any other. Rows equal in id and text share a key, are interchangeable and are each taken at
most ``cap`` times. Sources without words get a target of 0. An empty table gives an empty one.
Input columns named like an added one are replaced, those in ``WORKING`` are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60
ROWS_PER_RANGE = 500
MOST_RANGES = 1 << 16
ADDED = ["size", "source_size", "target", "taken"]
WORKING = ["_key", "_range", "_source", "_at", "_before", "_start", "_words"]  # not kept either


def keyed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``size`` in words and the hash-random ``_key``."""
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(named, F.lit(":"), text))
    return docs.drop(*ADDED, *WORKING).withColumns(
        {
            "size": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "_key": F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("long"),
        }
    )


def targets(
    sources: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Targets for rows (source, source_size); one row per source."""
    alphabetic = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(alphabetic) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = sources.withColumn("weight", weight).withColumn("most", F.lit(cap) * F.col("source_size"))
    everyone = Window.partitionBy()
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    to_share = F.lit(share) * F.sum("source_size").over(everyone)
    left = to_share - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    unfilled = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levelled = ranked.withColumn("level", left / unfilled)
    full = F.col("most") <= F.col("level") * F.col("weight")
    levelled = levelled.withColumn("full", full)
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(everyone)
    return levelled.withColumn("final", final).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def mix(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """Add source_size, target and taken, the words the mix takes from a row, to ``keyed`` rows.

    ``sized`` is read three times: to count rows, to sum ranges and to take.
    """
    rows = sized.count()
    ranges = min(MOST_RANGES, 1 << max(0, (rows // ROWS_PER_RANGE)).bit_length())
    width = (1 << KEY_BITS) // ranges
    placed = sized.withColumn("_range", (F.expr(f"_key div {width}")).cast("int"))
    sums = placed.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    per_source = sums.groupBy("source").agg(F.sum("_words").alias("source_size"))
    goals = targets(per_source, weights, share, cap)
    earlier = (
        Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    g, o = goals.alias("g"), offsets.alias("o")
    known = o.join(g, F.col("o.source").eqNullSafe(F.col("g.source"))).select(
        F.col("o.source").alias("_source"),
        F.col("o._range").alias("_at"),
        "_before",
        "source_size",
        "target",
    )
    joined = placed.join(
        known, (F.col("_range") == F.col("_at")) & F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source", "_at")
    inside = (
        Window.partitionBy("source", "_range")
        .orderBy("_key", "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_start"), F.lit(0)), F.col("size"))
    return (
        joined.withColumn("_start", start)
        .withColumn("taken", (epochs * F.col("size") + part).cast("long"))
        .drop("_start", "_before", "_key", "_range")
    )


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row per copy taken; where a budget ends inside a document, its first words.

    Documents without words take nothing from a budget and stay, once.
    """
    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size == 0, F.lit(1)).otherwise(F.floor(taken / size)).cast("int")
    rest = F.when(size == 0, F.lit(0)).otherwise(taken - whole * size)
    full = F.array_repeat(F.lit(0).cast("long"), whole)
    each = F.concat(full, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))
    exploded = mixed.withColumn("_words", F.explode(each))
    text = F.when(F.col("_words") == 0, F.col("text")).otherwise(first_words(F.col("text"), F.col("_words")))
    return exploded.withColumn("text", text).drop("_words")
