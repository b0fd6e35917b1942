"""Secret scan over a trigram inverted index, natively.

From each rule's pattern a Boolean query over trigrams is derived: alternatives, each a set of
trigrams that a match must hold. The index has a posting (trigram, document) for every trigram
of any query; joined with the queries and counted per document and alternative, the postings are
intersected, and only documents that fulfil an alternative are searched with the rule's pattern.
A rule whose pattern has no mandatory trigram searches every text. Trigrams are compared in lower
case, so the index can only name too many documents, never too few.

Spans are counted in code points, end exclusive; matches of one rule never overlap, the leftmost
comes first, and a match whose value is too short is dropped after it has used up its text.

Nulls and repeats: a null text is empty and has no spans; rows with one id are searched one by
one; a null id joins with null. An empty table gives an empty one; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LITERALS = 32  # literal beginnings that a derivation follows at once


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, and how long the value in ``group`` must be."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
        r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of 24 or more is a whole run
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of mandatory trigrams, in lower case; None if a match may have none.

    Walks the pattern's parts in order and keeps the set of literal texts that the part read so
    far can end in; whenever that set would grow too large or a part is open-ended, the trigrams
    of the literals are noted and the walk starts afresh.
    """
    found: list[list[frozenset[str]]] = []

    def note(literals: set[str]) -> None:
        grams = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in literals]
        if grams and all(grams):
            found.append(grams)

    held = {""}
    for options in _literal_parts(re._parser.parse(pattern)):
        if options is None:
            note(held)
            held = {""}
        elif len(held) * len(options) > MOST_LITERALS:
            note(held)
            held = options
        else:
            held = {a + b for a in held for b in options}
    note(held)
    # any of the noted conditions may serve; the one with the rarest shape has most trigrams
    best = max(found, key=lambda alts: min(map(len, alts)), default=None)
    if best is None:
        return None
    return sorted({a for a in best if not any(b < a for b in best)}, key=sorted)


def _literal_parts(parsed):
    """The parts of a parsed pattern as sets of lower-case texts, None where anything may stand."""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            yield {chr(arg).lower()}
        elif name == "IN":
            chars = {chr(a).lower() for o, a in arg if str(o) == "LITERAL"}
            plain = all(str(o) == "LITERAL" for o, _ in arg)
            yield chars if plain and len(chars) <= 8 else None
        elif name == "SUBPATTERN":
            yield from _literal_parts(arg[3])
        elif name == "BRANCH":
            yield _one_of(arg[1])
        elif name == "MAX_REPEAT" and arg[1] == 1 and arg[0] == 0:
            inner = _one_of([arg[2]])
            yield None if inner is None else inner | {""}
        else:
            yield None


def _one_of(branches) -> set[str] | None:
    out: set[str] = set()
    for branch in branches:
        texts = {""}
        for options in _literal_parts(branch):
            if options is None:
                return None
            texts = {a + b for a in texts for b in options}
            if len(texts) > MOST_LITERALS:
                return None
        out |= texts
    return out if len(out) <= MOST_LITERALS else None


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """The inverted index: a row (trigram, doc_id) for each of the trigrams that a text holds."""
    lower = docs.select("doc_id", F.lower("text").alias("lower"))
    held = F.array(*[F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams])
    return lower.select(F.explode(F.array_compact(held)).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """(_doc, _kinds): the rules whose query a document's postings fulfil."""
    wanted = []
    for rule in rules:
        for i, grams in enumerate(trigram_query(rule.pattern) or []):
            wanted += [(rule.kind, i, len(grams), g) for g in sorted(grams)]
    if not wanted:
        return None
    queries = docs.sparkSession.createDataFrame(wanted, "kind string, alt int, needs int, trigram string")
    index = postings(docs, sorted({w[3] for w in wanted}))
    met = (
        index.join(F.broadcast(queries), "trigram")
        .groupBy("doc_id", "kind", "alt", "needs")
        .agg(F.count_distinct("trigram").alias("has"))
        .filter("has = needs")
    )
    return met.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("kind").alias("_kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Matches of one rule as (start, kind's place, end)."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    kind = "array<struct<start:int,kind:int,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["all"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        kept = F.when(F.length(x["value"]) >= rule.least, F.array(span)).otherwise(F.array().cast(kind))
        return F.struct(end.alias("at"), F.concat(acc["spans"], kept).alias("spans"))

    walked = F.aggregate(found, begin, step)["spans"]
    return F.when(F.rlike(text, pattern), walked).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and, in the order of starts, the spans (start, kind's place in ``rules``, end)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    named = candidates(texts, indexed)
    if named is not None:
        texts = texts.join(named, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    parts = []
    for i, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule, i)
        if rule in indexed:
            spans = F.when(F.array_contains("_kinds", rule.kind), spans)
        parts.append(F.coalesce(spans, F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return texts.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def written_spans(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    each = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, each), ",")
