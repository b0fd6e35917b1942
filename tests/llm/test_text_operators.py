"""Operators on texts against plain versions, on odd documents and on none."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorlens.llm import chat, jaccard, lines, mixing, packing, quality, secrets, tokens
from sensorlens.llm.registry import load
from sensorlens.llm.tables import new_path
from sensorlens.llm.token_ids import WordEncoder, default_tokenizer

QUERIES = load()[0]


def key(row):
    return tuple((v is not None, v) for v in row)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- secrets


def plain_secrets(text):
    found = []
    for place, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), place, m.end()))
    return sorted(found)


def test_secrets_as_plain_search(odd_docs, clashing):
    got = [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in secrets.scan(odd_docs).collect()]
    want = [(r["doc_id"], plain_secrets(r["text"])) for r in odd_docs.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert secrets.scan(clashing).count() == len(want)


def test_no_documents_no_secrets(no_docs):
    assert secrets.scan(no_docs).count() == 0


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("token=token:abcdef", []),  # a match that is too short has used up its text
        ("token==abcdef Secret : 'zzzzzz'", ["assign", "assign"]),
        ("AKIAAKIA" + "7" * 12, ["access"]),
        ("\U0001f600 api-key=1 apikey=" + "ab" * 12, ["assign", "hex"]),
    ],
)
def test_secret_cases(spark, text, kinds):
    spans = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["spans"]
    assert [secrets.RULES[s["kind"]].kind for s in spans] == kinds
    assert [tuple(s) for s in spans] == plain_secrets(text)


def test_trigram_queries_hold_in_every_match():
    samples = ["PassWd: abcdef", "api_KEY='abcdef'", "apikey=abcdef", "AKIA" + "A" * 16, "ghp_" + "a" * 36]
    for sample in samples:
        held = {sample.lower()[i : i + 3] for i in range(len(sample))}
        for rule in secrets.RULES:
            alternatives = secrets.trigram_query(rule.pattern)
            if alternatives is not None and re.search(rule.pattern, sample):
                assert any(a <= held for a in alternatives)
    assert secrets.trigram_query("[0-9a-f]{24,}") is None
    assert secrets.trigram_query("ab|abcd") is None


# --- lines


def plain_near(body, others, percent):
    for other in others:
        most = max(2, min(len(body), len(other)) * percent // 100)
        if abs(len(body) - len(other)) <= most and lines._plain_distance(body, other) <= most:
            return True
    return False


def plain_lines(rows, edits=2, percent=0):
    """(doc_id, kept text, lines, equal, near) by comparing every line with all earlier ones."""
    white = " \t\n\r\x0b\x0c"
    spread = defaultdict(list)
    for r in rows:
        spread[(r[0], r[1] or "")].append(r)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first, done, out = {}, set(), []
    for r in order:
        same = (r[0], r[1] or "")
        if same in done:
            continue
        done.add(same)
        kept, n, equal, near = [], 0, 0, 0
        for line in (r[1] or "").split("\n"):
            body = line.strip(white).encode()
            if not body:
                kept.append(line)
                continue
            n += 1
            if body in first:
                equal += 1
                continue
            long = len(body) >= lines.SHORTEST
            others = [b for b in first if long and len(b) >= lines.SHORTEST]
            if percent:
                is_near = plain_near(body, others, percent)
            else:
                is_near = lines.within_edits([body] * len(others), others, edits).any()
            if is_near:
                near += 1
            else:
                kept.append(line)
            first[body] = True
        for copy in spread[same]:
            out.append((copy[0], None if copy[1] is None else "\n".join(kept), n, equal, near))
    return out


@pytest.mark.parametrize("percent", [0, 5])
def test_lines_as_plain_comparison(odd_docs, clashing, no_docs, percent):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.filter("doc_id is not null").collect()]
    source = odd_docs.filter("doc_id is not null")
    got = lines.dedup_lines(source, percent=percent).select("doc_id", "text", "n_lines", "n_equal", "n_near")
    assert rows_of(got) == sorted(plain_lines(rows, percent=percent), key=repr)
    odd = lines.dedup_lines(clashing, percent=percent)
    assert set(odd.columns) == set(clashing.columns) | {"n_equal", "n_near"} and odd.count() == clashing.count()
    assert lines.dedup_lines(no_docs, percent=percent).count() == 0
    assert lines.dedup_lines(odd_docs, percent=percent).count() == odd_docs.count()


def test_very_long_lines_are_compared_whole(spark):
    rng = random.Random(8)
    line = bytearray(rng.choices(b"abcdefgh ijkl", k=60_000))
    near, far = bytearray(line), bytearray(line)
    for copy, changes in ((near, 900), (far, 9_000)):
        for at in rng.sample(range(len(line)), changes):
            copy[at] = ord("Z")
    texts = [t.decode().strip() for t in (line, near, far)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_near"] for r in lines.dedup_lines(docs, percent=5).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_edit_distance():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(600):
        x = bytearray(rng.choices(b"abc", k=rng.randint(0, 50)))
        y = bytearray(x)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, len(y))
            y[at : at + rng.randint(0, 1)] = rng.choices(b"abc", k=rng.randint(0, 1))
        a.append(bytes(x))
        b.append(bytes(y))
    for edits in (0, 1, 2, 5):
        want = [lines._plain_distance(x, y) <= edits for x, y in zip(a, b)]
        assert lines.within_edits(a, b, edits).tolist() == want


def test_every_near_pair_is_a_candidate(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab ", k=rng.randint(32, 40))) for _ in range(20)]
    for t in texts[:20]:
        for _ in range(3):
            at = rng.randrange(len(t))
            texts.append(t[:at] + rng.choice(["", "x", "xy"]) + t[at + rng.randint(0, 1) :])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    got = lines.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_equal", "n_near")
    assert rows_of(got) == sorted(plain_lines(rows), key=repr)


def plain_growing(rows, percent):
    """Lines near an earlier one, by the plain distance of every pair."""
    gone, seen = [], []
    for _, text in sorted(rows):
        body = text.strip().encode()
        for other in seen:
            most = max(2, min(len(body), len(other)) * percent // 100)
            if abs(len(body) - len(other)) <= most and lines._plain_distance(body, other) <= most:
                gone.append(text)
                break
        seen.append(body)
    return gone


def test_replaced_and_deleted_words_make_near_lines(spark):
    rng = random.Random(11)
    texts = []
    for n in (6, 9, 14, 30):
        for _ in range(3):
            words = ["".join(rng.choices("abcdefé", k=rng.randint(2, 9))) for _ in range(n)]
            texts.append(" ".join(words))
            for changes in (1, 1, 1, 2, 3):
                copy = list(words)
                for _ in range(changes):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = rng.choice([[], ["".join(rng.choices("abcdef", k=4))]])
                texts.append(" ".join(copy))
    texts += ["ab" * 30, "ab" * 31, "ab" * 40, "字" * 40, "字" * 39 + "語", "字" * 30 + "語" * 10]
    rng.shuffle(texts)
    texts = [t for t in dict.fromkeys(texts) if len(t.encode()) >= lines.SHORTEST]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_growing(rows, 5)
    got = lines.dedup_lines(docs, percent=5)
    assert sorted(texts[r["doc_id"]] for r in got.filter("n_near = 1").collect()) == sorted(want)
    assert len(want) > lines.dedup_lines(docs).filter("n_near = 1").count() + 10


def test_lines_that_share_a_common_passage_share_no_anchors(spark):
    rng = random.Random(3)
    common = "this passage stands in every line of all the documents, word for word"
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=150))
    texts = [own() + common + own() for _ in range(300)]
    copies = [t.replace("passage", "text") for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string")
    shared = lines.anchors(docs, 2, 5).groupBy("key").agg(F.count_distinct("line").alias("n"))
    assert shared.agg(F.max("n")).first()[0] < 60  # the 40 lines of pairs; 320 by chance alone
    gone = lines.dedup_lines(docs, percent=5).filter("n_near = 1")
    assert sorted(r["doc_id"] for r in gone.collect()) == list(range(300, 320))


def test_query_takes_out_lines_with_a_word_replaced(spark, tmp_path):
    words = [f"word{i:02d}x" for i in range(40)]
    other = words[:20] + ["changed"] + words[21:]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:11] + words[12:])), (4, " ".join(words[20:] + words[:20]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_near"] for r in QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_distance_within_a_bound_of_any_size():
    rng = random.Random(5)
    for _ in range(400):
        x = bytearray(rng.choices(b"abc", k=rng.randint(0, 150)))
        y = bytearray(x)
        for _ in range(rng.randint(0, 60)):
            at = rng.randint(0, len(y))
            y[at : at + rng.randint(0, 1)] = rng.choices(b"abc", k=rng.randint(0, 1))
        far = lines._plain_distance(bytes(x), bytes(y))
        for most in (far - 1, far, far + 3):
            assert lines._distance_within(bytes(x), bytes(y), most) == (most >= far)


def test_banded_distance_of_long_texts():
    rng = random.Random(6)
    for _ in range(60):
        x = bytearray(rng.choices(b"ab", k=rng.randint(200, 400)))
        y = bytearray(x)
        for _ in range(rng.randint(0, 25)):
            at = rng.randint(0, len(y))
            y[at : at + rng.randint(0, 2)] = rng.choices(b"abc", k=rng.randint(0, 2))
        far = lines._plain_distance(bytes(x), bytes(y))
        for most in {max(1, far - 1), max(1, far), far + 1, far + 9}:
            assert lines._distance_within(bytes(x), bytes(y), most) == (most >= far)
            assert lines._distance_within(bytes(y), bytes(x), most) == (most >= far)


# --- sets of shingles


def plain_groups(rows):
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.append(grams)
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def test_groups_as_plain_comparison(odd_docs, clashing, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(jaccard.link_classes(odd_docs)) == sorted(plain_groups(rows), key=repr)
    assert jaccard.link_classes(clashing).count() == len(rows)
    assert jaccard.link_classes(no_docs).count() == 0


def test_chains_of_near_copies_and_links_at_the_threshold(spark):
    """Sliding windows link only to their neighbours: leaders do not reach all, trees must."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(700)]
    rows = [(i, " ".join(words[i * 9 : i * 9 + 85])) for i in range(60)]
    rows += [(100 + i, " ".join(words[:84] + rng.choices(words, k=i))) for i in range(30)]
    # 9 shingles of 5 words: one shared start of 12 words gives 8 of 10
    rows += [(200, "q w e r t y u i o p a s d"), (201, "q w e r t y u i o p a s f")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard.link_classes(docs)) == sorted(plain_groups(rows), key=repr)


def test_groups_do_not_depend_on_blocks_and_trees(spark, monkeypatch):
    """An opening that all texts share, in blocks of a few sets and trees of a few postings."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(900)]
    rows = [(i, " ".join(words[:18] + words[18 + i * 4 : 60 + i * 4])) for i in range(120)]
    rows += [(200 + i, " ".join(words[:10] + rng.choices(words, k=1 + i % 3))) for i in range(60)]
    want = sorted(plain_groups(rows), key=repr)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "HOT", 7)
    monkeypatch.setattr(jaccard, "TREE_ROWS", 25)
    assert rows_of(jaccard.link_classes(docs)) == want
    monkeypatch.setattr(jaccard, "TREE_LISTED", 40)
    assert rows_of(jaccard.link_classes(docs)) == want


def test_prefix_lengths_are_safe():
    for percent in (50, 80, 95):
        for a in range(1, 60):
            for b in range(a, 60):
                need = -(-percent * (a + b) // (100 + percent))
                if need <= a:
                    assert jaccard.index_length(a, percent) >= a - need + 1
                    assert jaccard.prefix_length(b, percent) >= b - need + 1


# --- mixing


def test_mix_meets_budgets(odd_docs, clashing, no_docs):
    got = mixing.mix(mixing.keyed(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"] or 0)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert own[0]["target"] <= 2 * own[0]["source_size"] == 2 * sum(r["size"] for r in own)
    again = mixing.mix(mixing.keyed(clashing)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix(mixing.keyed(no_docs)).count() == 0


def test_copies_hold_the_words_taken(odd_docs):
    mixed = mixing.mix(mixing.keyed(odd_docs)).cache()
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD))
    held = {r[0]: r[1] for r in mixing.copies(mixed).groupBy("source").agg(F.sum(count)).collect()}
    for source, taken in mixed.groupBy("source").agg(F.sum("taken")).collect():
        assert held.get(source, 0) == taken
    blank = mixed.filter("size = 0").count()
    assert mixing.copies(mixed).filter(count == 0).count() == blank


# --- tokens and packing


def plain_ids(text):
    tokenizer = WordEncoder.shared(default_tokenizer()).tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_the_tokenizer(odd_docs):
    texts = [r["text"] for r in odd_docs.collect()]
    texts += ["don't I'M x's", "a\x0bb\x0cc", "á ́b", "x.y,z!?", "≠a", "​q 10.5%", "A.́b"]
    ids, sizes = WordEncoder(default_tokenizer()).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    for text, end, n in zip(texts, ends, sizes):
        assert ids[end - n : end].tolist() == plain_ids(text), text


def test_token_files_round_trip(spark, odd_docs, clashing, no_docs):
    path = new_path(spark, "test")
    tokens.write_tokens(clashing, path, default_tokenizer())
    rows = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want = [(d, len(plain_ids(t)), zlib.crc32(np.array(plain_ids(t), "<u4").tobytes())) for d, t in rows]
    got = [tuple(r) for r in tokens.digests(spark, path).orderBy("start").collect()]
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(want, key=repr)
    assert [s for _, s, _, _ in got] == np.concatenate([[0], np.cumsum([n for _, _, n, _ in got])[:-1]]).tolist()
    assert [d for d, *_ in got] == [d for d, _ in rows]
    some = tokens.read_tokens(spark, path, [6, 13]).collect()
    assert {r["doc_id"] for r in some} == {6, 13} and len(some) == 4
    assert tokens.read_tokens(spark, path, with_ids=False).columns == ["doc_id", "n_tokens"]
    empty = new_path(spark, "test")
    tokens.write_tokens(no_docs, empty, default_tokenizer())
    assert tokens.digests(spark, empty).count() == 0


def test_pieces_cover_every_document_and_fill_sequences(odd_docs, clashing, no_docs):
    pieces = packing.pack(clashing, default_tokenizer()).cache()
    by_doc = Counter()
    for r in pieces.collect():
        by_doc[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == r["length"] and r["offset"] + r["length"] <= packing.SEQUENCE
    want = Counter()
    for r in odd_docs.collect():
        want[r["doc_id"]] += len(plain_ids(r["text"]))
    assert by_doc == want
    whole = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert [r["sequence_id"] for r in whole] == list(range(len(whole)))
    assert all(len(r["ids"]) == packing.SEQUENCE for r in whole[:-1])
    one = {(r["doc_id"], r["start"]): r for r in pieces.collect()}[(13, 0)]
    assert one["ids"] == plain_ids(odd_docs.filter("doc_id = 13").first()["text"])[: one["length"]]
    assert packing.pack(no_docs, default_tokenizer()).count() == 0


def test_hilbert_neighbours_touch():
    for axes, bits in ((2, 4), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = packing.hilbert_key(grid, bits)
        path = grid[np.argsort(keys)]
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# --- quality


def test_quality_ranks_held_out_labels(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, sf_dir.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/labels.parquet").collect()
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["quality"], got[r["doc_id"]]["score"]) for r in labels if got[r["doc_id"]]["held_out"]]
    good, bad = [s for q, s in held if q], [s for q, s in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_quality_of_odd_documents(spark, odd_docs, clashing, no_docs):
    labels = spark.createDataFrame(
        [(6, 1), (6, 0), (7, 1), (8, 1), (10, 1), (13, 0), (14, 0), (None, 1), (12, None), (18, 0), (19, 0), (20, 0)],
        "doc_id long, quality int",
    )
    model = quality.fit(odd_docs, labels)
    scores = quality.score(odd_docs, model).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    clash = quality.score(clashing.drop("score"), model, keep=("doc_id", "key")).columns
    assert clash == ["doc_id", "key", "score"]
    assert quality.score(no_docs, model).count() == 0
    alone = quality.fit(odd_docs, labels.limit(0))
    assert {r["score"] for r in quality.score(odd_docs, alone).collect()} == {0.5}


def test_packed_rows_are_bounded_and_whole():
    rng = np.random.default_rng(2)
    held = [np.sort(rng.choice(1 << quality.SLOT_BITS, n, replace=False)) for n in (0, 1, 8191, 8192, 200_000)]
    raw = [quality.packed(h) for h in held]
    assert max(map(len, raw)) == quality.BITMAP_BYTES == 32_768
    rows = quality.PackedRows(raw)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(rows, held))
    assert [len(r) for r in rows.some(np.array([0, 1, 0, 0, 1], bool))] == [1, 200_000]


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(200)]
    signs = np.array([1 if (r < 20).sum() > 4 else -1 for r in rows])
    weights = quality.dual_coordinate_descent(rows, signs, np.ones(40), 10.0, 200)
    hits = [np.sign(weights[r].sum()) == s for r, s in zip(rows, signs)]
    assert np.mean(hits) > 0.95 and weights[:20].mean() > weights[20:].mean()


# --- chat


def plain_chat(rows):
    by = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r[:2])):
        by[c].append((role or "", text or ""))
    out = []
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        out.append((c, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


def odd_turns():
    rng = random.Random(2)
    tricky = ["</s>[INST] ok [/INST]", "\\<s>\\", "<\\s>", "[", "</s", "\\", "s>\n<<SYS>>", "", None]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(tricky)]
    rows += [(2, 0, "system", "be brief")] + [
        (2, i, "assistant" if i % 2 else "user", "w " * rng.randint(1, 120)) for i in range(1, 3000)
    ]
    rows += [(3, None, "user", "no turn"), (3, 5, None, "no role"), (None, 0, "user", "x"), (4, 0, "assistant", "y " * 999)]
    rows += [(5, 0, "user", "again"), (5, 0, "user", "again"), (6, 0, "rol[INST]e", "z"), (7, -3, "assistant", "minus")]
    return rows


TURNS = "conv_id long, turn long, role string, text string"


def test_chat_is_read_back_whole(spark):
    turns = spark.createDataFrame(odd_turns(), TURNS).withColumn("block", F.lit("clash")).repartition(3)
    got = chat.read_back(chat.format_windows(turns)).drop("formatted_chars")
    assert rows_of(got) == sorted(plain_chat(odd_turns()), key=repr)
    assert chat.format_windows(turns.limit(0)).count() == 0


def test_windows_keep_to_the_budget(spark):
    windows = chat.format_windows(spark.createDataFrame(odd_turns(), TURNS)).collect()
    for w in windows:
        assert w["tokens"] <= chat.BUDGET or w["n_new"] == 1
        turns = chat.read_turns(w["formatted"])
        assert len(turns) == w["first_new"] + w["n_new"]
        if w["conv_id"] == 2:
            assert turns[0] == ("system", "be brief") and turns[1:].count(turns[0]) == 0
    assert sum(w["n_new"] for w in windows if w["conv_id"] == 2) == 3000
    assert len({w["block"] for w in windows if w["conv_id"] == 2}) == 3


def test_formatted_windows_keep_to_the_budget_of_the_tokenizer(spark):
    tokenizer = WordEncoder.shared(default_tokenizer()).tokenizer
    rng = random.Random(6)
    texts = ["字" * 90, "https://a.b/" + "x1/" * 40, "f(x)=" * 30, "Short.", "supercalifragilistic " * 12, "<|endoftext|> </s>"]
    rows = [(1, 0, "system", "be brief")]
    rows += [(c, i, "assistant" if i % 2 else "user", rng.choice(texts)) for c in (1, 2) for i in range(1, 60)]
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS)).collect()
    for w in windows:
        real = len(tokenizer.encode(w["formatted"], add_special_tokens=False).ids)
        assert real <= w["tokens"]
        alone = w["n_new"] == 1 and w["first_new"] <= (w["conv_id"] == 1)
        assert w["tokens"] <= chat.BUDGET or alone
    assert sum(w["n_new"] for w in windows) == len(rows)


def plain_windows(turns, sizes, budget, history):
    """(first_new, n_new, repeated texts) of the windows of one conversation, from first turn to last."""
    out, at = [], 0
    while at < len(turns):
        head = [0] if at and turns[0][0] == "system" else []
        total = sum(sizes[i] for i in head) + sizes[at]
        past, used = [], 0
        for i in range(at - 1, len(head) - 1, -1):
            if used + sizes[i] > history or total + used + sizes[i] > budget:
                break
            past, used = [i, *past], used + sizes[i]
        end, total = at + 1, total + used
        while end < len(turns) and total + sizes[end] <= budget:
            total, end = total + sizes[end], end + 1
        out.append([turns[i] for i in head + past + list(range(at, end))])
        at = end
    return out


@pytest.mark.parametrize("step", [1, 1000, 5000])
def test_windows_do_not_depend_on_turn_numbers_or_blocks(spark, step):
    tokenizer = WordEncoder.shared(default_tokenizer()).tokenizer
    rng = random.Random(9)
    rows = [(1, 0, "system", "be brief")]
    rows += [(1, i * step, "assistant" if i % 2 else "user", f"n{i} " + "w " * rng.randint(0, 40)) for i in range(1, 2100)]
    turns = [(r, t) for _, _, r, t in rows]
    sizes = [len(tokenizer.encode(chat._written(r, t), add_special_tokens=False).ids) for r, t in turns]
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS).repartition(5)).orderBy("block", "window").collect()
    assert [chat.read_turns(w["formatted"]) for w in windows] == plain_windows(turns, sizes, chat.BUDGET, chat.HISTORY)
    assert len({w["block"] for w in windows}) == 3


def test_chat_sort_keys_hold_no_whole_text(spark):
    """Long texts of one turn number keep their order and stay out of the range borders."""
    rows = [(1, 0, "user", "a" * 50_000 + c) for c in "bca"] + [(1, 0, "user", "A"), (1, None, "user", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain, least = chat.numbered(turns, chat.default_tokenizer())
    placed = {r["position"]: r["text"] for r in plain.collect()}
    assert [placed[i][:5] for i in (0, 1)] == ["first", "A"] and len(placed) == 5
    assert least == min(r["tokens"] for r in plain.collect()) > 0


def test_encoder_forgets_the_later_half(monkeypatch):
    from sensorlens.llm import token_ids

    monkeypatch.setattr(token_ids, "CACHED_WORDS", 40)
    encoder = token_ids.WordEncoder(token_ids.default_tokenizer())
    rng = random.Random(8)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abcde", k=rng.randint(1, 3))) for _ in range(12)) for _ in range(3)]
        ids, sizes = encoder.encode(pa.array(texts), None)
        whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [x for w in whole for x in w] and sizes.tolist() == [len(w) for w in whole]
