"""The pipeline's stages on the given tables and on odd documents."""

import pytest

import corpus_pipeline
from sensorlens.llm import quality
from sensorlens.llm.tables import written
from test_text_operators import plain_groups, plain_lines


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {"documents": None}
    kept["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        kept[name] = docs
    return kept


def test_stages_keep_the_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_stage(spark, sf_dir, stages):
    docs = stages["documents"]
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {r["doc_id"] for r in quality.score(docs, model).filter("score >= 0.3").collect()}
    got = stages["quality_classifier"].collect()
    assert {r["doc_id"] for r in got} == want and len(got) == len(want) < docs.count()


def test_line_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality_classifier"].collect()]
    want = {d: text for d, text, n, equal, near in plain_lines(rows) if not 0 < n == equal + near}
    assert {r["doc_id"]: r["text"] for r in stages["line_dedup"].collect()} == want


def test_group_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["line_dedup"].collect()]
    want = sorted(d for d, _, head in plain_groups(rows) if d == head)
    assert sorted(r["doc_id"] for r in stages["ngram_jaccard_join"].collect()) == want


def test_mixing_and_packing_stages(stages):
    words = lambda name: sum(len(r["text"].split()) for r in stages[name].collect())
    assert abs(words("source_mixing") / words("ngram_jaccard_join") - 1.5) < 0.02
    pieces = stages["packing"].collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in stages["source_mixing"].collect()}


def test_stages_survive_odd_documents(spark, odd_docs, no_docs, sf_dir):
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
        assert docs.count() >= (start is odd_docs)
    assert corpus_pipeline.keep_one_per_group(spark, odd_docs, sf_dir).filter("doc_id = 6").count() == 1
