"""Reading tables: full, first rows, random sample, one chunk; CSV dialects and number parsing."""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlens.functions.columns import (
    missing_to_null,
    quoted,
    require_columns,
    split_number,
)
from sensorlens.functions.frames import long_report
from sensorlens.operators.order_stats import smallest_rows

READ_MODES = ("full", "sample", "random_sample", "chunked")
# Texts that stand for a missing value in delimited files.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class ReadStrategy:
    """How much of a table to read; checked before any job starts.

    full: everything. sample: the first ``sample_rows`` rows by key. random_sample:
    ``sample_rows`` rows chosen by a hash of the key. chunked: the first ``chunk_size`` rows
    by key; to work through all chunks see :mod:`sensorlens.streaming.profile_stream`.
    """

    mode: str = "full"
    sample_rows: int = 200_000
    random_state: int = 42
    chunk_size: int = 200_000

    def __post_init__(self):
        if self.mode not in READ_MODES:
            raise ValueError(f"mode must be one of {READ_MODES}, got {self.mode!r}")
        for name in ("sample_rows", "chunk_size"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be > 0")


# Python's name of an encoding where Spark's differs.
SPARK_CHARSETS = {"iso8859-1": "iso-8859-1", "ascii": "us-ascii"}


@dataclass(frozen=True)
class CsvOptions:
    sep: str = ","
    encoding: str = "utf-8"
    decimal: str = "."

    def reader_options(self) -> dict[str, str]:
        name = codecs.lookup(self.encoding).name
        return {"header": "true", "sep": self.sep, "encoding": SPARK_CHARSETS.get(name, name)}


def apply_strategy(df: DataFrame, strategy: ReadStrategy, key: str | None) -> DataFrame:
    if strategy.mode == "full":
        return df
    if key is None:
        raise ValueError(f"mode {strategy.mode} needs a key column to be repeatable")
    require_columns(df, [key], "key")
    if strategy.mode == "sample":
        return smallest_rows(df, strategy.sample_rows, key)
    if strategy.mode == "chunked":
        return smallest_rows(df, strategy.chunk_size, key)
    return smallest_rows(
        df, strategy.sample_rows, split_number(quoted(key), strategy.random_state)
    )


def read_table(
    spark: SparkSession,
    path: str,
    strategy: ReadStrategy = ReadStrategy(),
    key: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """A columnar table with NaN read as missing. A missing path fails at once."""
    df = missing_to_null(spark.read.format(format).load(path))
    return apply_strategy(df, strategy, key)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    options: CsvOptions = CsvOptions(),
    strategy: ReadStrategy = ReadStrategy(),
    key: str | None = None,
) -> DataFrame:
    """A delimited file with header.

    With ``schema`` every number column is parsed from text by :func:`parse_number`: the
    decimal mark is honoured and NA texts are missing. Without it the types are inferred,
    which costs one more pass over the file, and the decimal mark must be a point.
    """
    reader = spark.read.options(**options.reader_options())
    if schema is None:
        if options.decimal != ".":
            raise ValueError("a decimal mark other than '.' needs a schema")
        df = reader.option("inferSchema", "true").csv(path)
        return apply_strategy(_blank_na_texts(missing_to_null(df)), strategy, key)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = _by_header(reader.option("inferSchema", "false").csv(path), schema)
    return apply_strategy(parse_columns(raw, schema, options.decimal), strategy, key)


def _by_header(raw: DataFrame, schema: T.StructType) -> DataFrame:
    require_columns(raw, schema.names, "declared column")
    return raw.select(*[quoted(c) for c in schema.names])


def _blank_na_texts(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~is_na_text(quoted(c)), quoted(c)) for c in texts})


def is_na_text(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(*NA_TOKENS)


def parse_number(text: Column, kind: T.DataType, decimal: str = ".") -> Column:
    """Number in a text, missing for NA texts and for anything that is no number."""
    plain = F.trim(text)
    if decimal != ".":
        plain = F.replace(plain, F.lit(decimal), F.lit("."))
    number = plain.try_cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        number = F.nanvl(number, F.lit(None))
    return F.when(~is_na_text(text), number)


def parse_columns(raw: DataFrame, schema: T.StructType, decimal: str = ".") -> DataFrame:
    picked = []
    for f in schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, T.NumericType):
            c = parse_number(c, f.dataType, decimal)
        elif isinstance(f.dataType, T.StringType):
            c = F.when(~is_na_text(c), c)
        else:
            c = F.when(~is_na_text(c), c.try_cast(f.dataType))
        picked.append(c.alias(f.name))
    return raw.select(*picked)


def parse_report(raw: DataFrame, columns: Iterable[str], decimal: str = ".") -> DataFrame:
    """Per text column: rows, NA texts, numbers, and texts that are neither."""
    columns = list(columns)
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        parsed = parse_number(quoted(c), T.DoubleType(), decimal)
        aggs += [
            F.count_if(is_na_text(quoted(c))).alias(f"m{i}"),
            F.count(parsed).alias(f"p{i}"),
        ]
    rows: list[Mapping[str, Column]] = [
        {
            "column": F.lit(c),
            "n_rows": F.col("rows"),
            "missing": F.col(f"m{i}"),
            "parsed": F.col(f"p{i}"),
            "failed": F.col("rows") - F.col(f"m{i}") - F.col(f"p{i}"),
        }
        for i, c in enumerate(columns)
    ]
    return long_report(raw.agg(*aggs), rows)


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(quoted(key)).limit(n)
