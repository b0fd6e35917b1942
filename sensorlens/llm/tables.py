"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where it is unset a folder beside the warehouse's tables."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return held or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


_OPEN: list[list[str]] = []  # tables written inside the scratch blocks that are open


def new_path(spark: SparkSession, kind: str) -> str:
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.append(path)
    return path


def written(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write a frame down and go on from the table: computed once, kept if executors are lost."""
    path = new_path(df.sparkSession, kind)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _without_scheme(path: str) -> str:
    return "/" + path.split(":", 1)[-1].lstrip("/")


def release(df: DataFrame) -> None:
    """Delete the tables behind a frame made by ``written``, once nothing reads it any more."""
    spark = df.sparkSession
    shared = _without_scheme(shared_folder(spark)) + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if _without_scheme(folder).startswith(shared):
            delete(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written inside, at the end: what is kept must have been read by then."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in made:
            delete(spark, path)
