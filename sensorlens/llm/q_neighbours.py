"""op10: approximate nearest neighbours of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.graph import build_graphs, nearest
from sensorlens.llm.registry import query, table
from sensorlens.llm.vectors import usable


@query("op10_graph_neighbours")
def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings")).filter(F.exists("v", lambda x: x != 0))
    return nearest(build_graphs(rows), rows.filter("vec_id % 100 = 0"), 10)
