"""op11: 16 clusters of the embeddings after three rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm.heapmeans import cluster, whole_vectors, with_inertia
from sensorlens.llm.registry import query, table

_NEAREST = """
a{i} as (
  select vec_id, nr, v, cluster, distance from (
    select p.vec_id, p.nr, p.v, c.cluster, c.distance,
      row_number() over (partition by p.nr order by c.distance, c.cluster) as place
    from pts p, lateral (
      select k.cluster, list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(p.v, k.v)])::bigint as distance
      from c{i} k) c)
  where place = 1)"""
_MOVED = """
c{n} as (
  select k.cluster, coalesce(m.v, k.v) as v from c{i} k left join (
    select cluster, list((s - ((s % n) + n) % n) // n order by place) as v from (
      select cluster, place, sum(x)::bigint as s, count(*) as n from (
        select cluster, unnest(v) as x, unnest(range(64)) as place from a{i})
      group by cluster, place)
    group by cluster) m on k.cluster = m.cluster)"""
CLUSTER_SQL = (
    """
with pts as materialized (
  select vec_id, row_number() over () as nr, [floor(64 * x::double)::bigint for x in embedding] as v from embeddings
  where len(embedding) = 64 and len([x for x in embedding if x is not null and isfinite(x)]) = 64),
c0 as (
  select (row_number() over (order by sha256('1:' || vec_id), v) - 1)::int as cluster, v from pts
  order by cluster limit 16),"""
    + ",".join(_NEAREST.format(i=i) + "," + _MOVED.format(i=i, n=i + 1) for i in range(3))
    + ","
    + _NEAREST.format(i=3)
    + """
select a.vec_id, a.cluster, a.distance,
  (sum(a.distance) over (partition by a.cluster))::bigint as cluster_inertia,
  (sum(a.distance) over ())::bigint as inertia,
  sha256(array_to_string(k.v, ',')) as centroid_sha256
from a3 a join c3 k on a.cluster = k.cluster
"""
)


@query("op11_heap_means", CLUSTER_SQL)
def op11_heap_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), scale=64, width=64)
    return with_inertia(cluster(rows, k=16, rounds=3, seed=1))
