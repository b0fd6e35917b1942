"""Small frame helpers: local report rows, wide-to-long reports, lineage cuts."""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def report_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A frame from report rows already on the driver (one row per column or per class)."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)


def long_report(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per mapping, without touching the data again."""
    structs = [F.struct(*[c.alias(name) for name, c in r.items()]) for r in rows]
    return one_row.select(F.inline(F.array(*structs)))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package wherever the driver was started."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which the driver and all executors share.

    Where the setting is missing, a folder in the warehouse, which is shared as well.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame down once and go on from the written table.

    For frames that several jobs read: the plan behind them runs once, the rows survive the
    loss of executors, and as a columnar table later jobs read only the columns they need.
    The table goes with :func:`release`, and what is left when Python ends goes then, whether or
    not the session has been stopped.
    """
    spark = df.sparkSession
    path = new_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FOLDERS: dict[str, dict[str, JavaObject]] = {}  # by application: paths and Hadoop settings


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path for a table, for files that arrive or for the state of a stream; it goes as tables do."""
    path = f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    _FOLDERS.setdefault(sc.applicationId, {})[path] = sc._jsc.hadoopConfiguration()
    return path


def tables_left(spark: SparkSession) -> list[str]:
    """The written folders of this application that have not been released."""
    return sorted(_FOLDERS.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, paths: Sequence[str] | None = None) -> None:
    """Delete written folders, by default all of the application: nothing may read them after."""
    held = _FOLDERS.get(spark.sparkContext.applicationId, {})
    for path in list(held) if paths is None else paths:
        _delete(path, held.pop(path, None) or spark.sparkContext._jsc.hadoopConfiguration())


def _delete(path: str, settings: JavaObject) -> None:
    target = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(settings).delete(target, True)


def _release_at_exit() -> None:
    # the JVM outlives a stopped session, and with it the settings kept beside the paths
    for held in _FOLDERS.values():
        for path, settings in held.items():
            try:
                _delete(path, settings)
            except (Py4JError, OSError):  # the JVM is gone, or the file system was closed
                return


atexit.register(_release_at_exit)
