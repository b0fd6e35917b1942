"""Byte-level BPE against another library, offsets, round trips and split characters."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sensorlens.llm import byte_bpe
from sensorlens.llm.registry import load

BPE = byte_bpe.ByteBpe(byte_bpe.default_ranks())
OTHER = tiktoken.Encoding(
    "other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_ranks()), special_tokens={}
)


def test_ids_as_the_other_library():
    rng = random.Random(5)
    kinds = ["abc'sted  \n", "ab1 2 \t", "é漢 字🙂́x", " \x85 　a.", "<|endoftext|> "]
    texts = ["".join(rng.choices(rng.choice(kinds), k=rng.randint(0, 60))) for _ in range(5_000)]
    ids, sizes = BPE.encode(texts)
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == [OTHER.encode_ordinary(t) for t in texts]


def test_every_code_point_is_split_alike():
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}a 1{c}1 !{c}! x{c}  {c}{c} y\n{c}" for c in points]
    ids, sizes = BPE.encode(texts)
    want = [x for t in OTHER.encode_ordinary_batch(texts, num_threads=4) for x in t]
    assert ids.tolist() == want


def test_long_texts_are_cut_where_no_match_reaches(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choices("ab1'.,é漢 \n\t", k=20_000)) + "é" * 3_000 + " end"
    monkeypatch.setattr(byte_bpe, "SPAN_CHARS", 50)
    assert BPE.encode([text])[0].tolist() == OTHER.encode_ordinary(text)


def test_offsets_point_at_the_characters():
    texts = ["plain words, here", "", "🙂漢 é́ x🙂", "a"]
    ids, sizes = BPE.encode(texts)
    starts, ends = BPE.code_points(ids, sizes)
    place = 0
    for text, n in zip(texts, sizes):
        for i in range(place, place + n):
            data = bytes(BPE.decode(ids[i : i + 1])[0])
            held = text[starts[i] : ends[i]]
            assert held and data in held.encode() and len(held.encode()) < len(data) + 6
        assert n == 0 or (starts[place] == 0 and ends[place + n - 1] == len(text))
        place += n


def test_query_over_whole_texts(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = load()[0]["op13_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, data = OTHER.encode_ordinary(texts[r["doc_id"]]), texts[r["doc_id"]].encode()
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(data).hexdigest()


def test_odd_documents_come_back(odd_docs, no_docs, clashing):
    for docs in (odd_docs, clashing):
        back = byte_bpe.decode(byte_bpe.encode(docs)).select("doc_id", F.decode("data", "UTF-8").alias("text"), "head", "tail")
        want = sorted(((r["doc_id"], r["text"] or "", 0, 0) for r in docs.collect()), key=repr)
        assert sorted(map(tuple, back.collect()), key=repr) == want
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).count() == 0
    with_offsets = byte_bpe.encode(odd_docs, offsets=True)
    assert with_offsets.filter("size(starts) <> n_tokens or size(ends) <> n_tokens").count() == 0


def test_characters_over_borders_stay_whole(spark):
    text = "a 🙂🙂 漢字 \U0001f9ff" * 20
    ids = BPE.encode([text])[0].tolist()
    rows = [(1, i, ids[i : i + 3]) for i in range(0, len(ids), 3)] + [(2, 0, None), (3, 0, [])]
    pieces = byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, start long, ids array<int>"), keep=("doc_id", "start"))
    held = {r["start"]: r for r in pieces.filter("doc_id = 1").collect()}
    assert any(r["head"] for r in held.values()) and any(r["tail"] for r in held.values())
    for a, b in zip(sorted(held), sorted(held)[1:]):
        assert (held[a]["tail"] > 0) == (held[b]["head"] > 0)
    assert {r["doc_id"]: r["text"] for r in byte_bpe.join_pieces(pieces).collect()} == {1: text, 2: "", 3: ""}


def test_ids_without_a_token_are_refused():
    for bad in ([-1], [50_256], [10**6]):
        with pytest.raises(ValueError):
            BPE.decode(np.array(bad))
