"""The queries of this subpackage: each has a Spark form and, where possible, the same in SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("q_secrets", "q_lines", "q_packing", "q_topk", "q_quality", "q_jaccard", "q_chat", "q_mixing", "q_tokens", "q_neighbours", "q_heapmeans", "q_byte_bpe", "q_variants")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for name in MODULES:
        importlib.import_module(f"sensorlens.llm.{name}")
    return dict(QUERIES), dict(ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
