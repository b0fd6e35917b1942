"""op4: the exact best inner products of vectors in whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.registry import query, table
from sensorlens.llm.topk import top_k
from sensorlens.llm.vectors import usable

TOPK_SQL = """
with v as (
  select vec_id, [floor(256 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null
    and len(embedding) = len([x for x in embedding if x is not null and isfinite(x)])),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum([a[1] * a[2] for a in list_zip(q.v, c.v)])::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
placed as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from placed where rank <= 5
"""


@query("op4_exact_topk", TOPK_SQL)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings")).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * 256)).alias("v")
    )
    return top_k(rows, rows.filter("vec_id % 50 = 0"), 5)
