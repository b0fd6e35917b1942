"""Column profile over files that keep arriving.

The batch profile itself is run as a streaming aggregate: counts, means, deviations and
extremes merge, so the state is one row per stream however many rows pass. Quantiles and
exact distinct counts do not merge in bounded state and stay batch operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorlens.functions.columns import missing_to_null
from sensorlens.functions.frames import new_folder
from sensorlens.operators.profile import column_stats


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream over the files of a folder, all that have arrived or ``files_per_batch`` at a time."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return missing_to_null(reader.load(path))


def start_profile(
    stream: DataFrame,
    table: str,
    cols: Sequence[str] | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Profile all files present, keeping the current totals in the in-memory ``table``.

    With a fixed ``checkpoint`` a later run continues from the totals and reads only new
    files; by default the run starts afresh in the session's checkpoint folder.
    """
    if checkpoint is None:
        checkpoint = new_folder(stream.sparkSession, "profile")
    return (
        column_stats(stream, cols)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def profile_available_files(stream: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Profile every file that has arrived so far, batch by batch, and return the result."""
    table = f"profile_{uuid.uuid4().hex}"
    start_profile(stream, table, cols).awaitTermination()
    return stream.sparkSession.table(table)
