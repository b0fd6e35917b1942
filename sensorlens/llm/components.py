"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on its smallest neighbour; each edge has a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        moved = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Links in either direction, repeated or from a node to itself do no harm; links with a null
    end are left out. Rounds go on until nothing changes; each is written down, so a
    lost executor costs one round at most.
    """
    edges = written(
        links.dropna(subset=["a", "b"])
        .filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = edges.agg(F.count("*"), total).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = written(_star(_star(edges, True), False), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
