"""Spelling variants against plain counting and plain neighbourhoods."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sensorlens.llm import variants
from sensorlens.llm.registry import load


def plain_counts(rows, dropped):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if dropped and digest % dropped == 0:
                at = digest % len(word)
                word = word[:at] + word[at + 1 :]
            if word:
                counts[word] += 1
    return counts


def plain_near(words):
    """Words at one edit: the same with one place open, or one with a letter taken out is the other."""
    near, open_ = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            open_[w[:i] + "\0" + w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in open_.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(counts):
    near, out = plain_near(set(counts)), {}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return sorted(out.values())


def answer(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_over_whole_texts(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    counts = {w: n for w, n in plain_counts(rows, 97).items() if len(w) >= 5 and n >= 3}
    assert answer(load()[0]["op12_spelling_variants"](spark, sf_dir)) == plain_variants(counts)


def test_counts_of_odd_documents(odd_docs, no_docs, clashing):
    for docs in (odd_docs, clashing):
        for dropped in (None, 3):
            got = {r["word"]: r["n"] for r in variants.word_counts(docs, dropped=dropped).collect()}
            assert got == plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()], dropped)
    assert variants.word_counts(no_docs, dropped=97).count() == 0


@pytest.mark.parametrize("letters, n, most", [("ab", 1_200, 40), ("abcdé×", 1_500, 200), ("aaaaaab", 400, 20_000)])
def test_few_letters_and_many_neighbours(spark, letters, n, most, monkeypatch):
    rng = random.Random(n)
    monkeypatch.setattr(variants, "frequent_grams", lambda w, f=variants.frequent_grams: f(w, most, 3))
    words = {"".join(rng.choices(letters, k=rng.randint(3, 12))) for _ in range(n)}
    counts = {w: rng.choice([3, 5, 6, 10, 40, 500]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("gram", F.lit("clash"))
    assert answer(variants.variants(df)) == plain_variants(counts)


def test_an_edit_leaves_a_posted_gram():
    rng = random.Random(4)
    frequent = {"".join(rng.choices("abc", k=q)): rng.randint(1, 9) for q in (2, 3, 4, 5) for _ in range(60)}
    for _ in range(3_000):
        word = "".join(rng.choices("abc", k=rng.randint(3, 14)))
        at, kind = rng.randrange(len(word)), rng.randrange(3)
        other = word[:at] + ("" if kind == 0 else rng.choice("abc")) + word[at + (kind < 2) :]
        longest = variants.longest_for(min(len(word), len(other)))
        if len(other) >= 3:
            a, b = (variants.posted(w, longest, frequent) for w in (word, other))
            assert {(s, g) for s, _, g in a} & {(s, g) for s, _, g in b} or {(e, g) for _, e, g in a} & {(e, g) for _, e, g in b}


def test_frequent_grams_are_bounded(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcd", k=8)) for _ in range(3_000)]
    df = spark.createDataFrame([(w, 1) for w in set(words)], "word string, n long")
    for most in (10, 100, 1_000):
        assert len(variants.frequent_grams(df, most, 1)) <= most


def test_no_words(spark):
    assert variants.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    alone = variants.variants(spark.createDataFrame([("alone", 3)], "word string, n long"))
    assert answer(alone) == [("alone", None, "alone", 3, 0, None)]
