"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept; ``run`` writes a stage's result down and reads
it again for the next one, so a lost executor never costs more than one stage. All stages but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm import jaccard, lines, mixing, packing, quality
from sensorlens.llm.tables import delete, new_path, scratch
from sensorlens.llm.token_ids import default_tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
GOOD_FROM = 0.3
ORACLE_SQL = None  # models, edit distances, set joins and tokens: tested against plain versions


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it is fitted on their labels."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, keep=tuple(COLUMNS))
    return scored.filter(F.col("score") >= GOOD_FROM).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat earlier ones; a document left without any line goes."""
    deduped = lines.dedup_lines(docs)
    emptied = (F.col("n_lines") > 0) & (F.col("n_equal") + F.col("n_near") == F.col("n_lines"))
    return _documents(deduped.filter(~emptied))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest id; repeated rows once.

    Rows without an id cannot be named as members of a group and stay.
    """
    classes = jaccard.link_classes(docs)
    heads = classes.filter("doc_id = component_id").select("doc_id").distinct()
    hashed = docs.withColumn("_text", F.xxhash64("text"))
    kept = hashed.join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id", "_text"])
    nameless = hashed.filter("doc_id is null")
    return kept.unionByName(nameless).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes; where a budget ends, a document's first words."""
    return _documents(mixing.copies(mixing.mix(mixing.keyed(docs))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, placed in sequences along the curve."""
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_per_group),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
