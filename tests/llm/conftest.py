import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def odd_documents():
    """Nulls in any column, empty and very long texts, copies, near copies, repeated rows."""
    rng = random.Random(3)
    base = _words(rng, 60)
    near = base.split()
    near[30] = "changed"
    lines = "\n".join(_words(rng, 12) for _ in range(6))
    texts = [
        None, "", "   ", "\n\n", "one", "one two three", base, base, " ".join(near), base.upper(), lines,
        lines + "\n" + base, lines.replace("a", "b", 1), _words(rng, 20_000), "é" * 70_000, "\x1f\x85  ok",
        'password = "abcdef"; AKIA' + "Q" * 16 + " " + "0f" * 20, "<|endoftext|> a <|ENDOFTEXT|>", "a" * 40,
        "a" * 39, "a" * 38 + "b", "İstanbul ΣΣ ẞ",
    ]
    rows = [(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], rows[10], (None, base, None, None, None), (None, None, None, None, None)]
    rows += [(100, "a source of its own", None, None, None), (101, "", "en", "empty", 0)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_documents(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The documents with columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = "row key n size taken target source_size _key _range _row _kept n_lines score sid file place ids".split()
    return odd_docs.withColumns({c: F.lit("clash") for c in names})
