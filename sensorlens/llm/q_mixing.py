"""op8: the words that a mix of the sources takes from each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm.mixing import keyed, mix
from sensorlens.llm.registry import query, table
from sensorlens.llm.tables import written

MIX_SQL = r"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15))::bigint as k
  from documents),
per_source as (
  select source, sum(size)::bigint as source_size, 2.0::double * sum(size) as most,
    ([3.0, 1.0, 2.0]::double[])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sized group by source),
levels as (
  select *, (1.5::double * sum(source_size) over ()
      - coalesce(sum(most) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over ()
      - coalesce(sum(weight) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)) as level
  from per_source),
goals as (
  select source, source_size, case when most <= level * weight then most
    else weight * max(case when not most <= level * weight then level end) over () end as target
  from levels),
placed as (
  select s.doc_id, s.size, g.source_size, g.target, floor(g.target)::bigint as budget,
    coalesce(sum(s.size) over (partition by s.source order by s.k, s.doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sized s join goals g on s.source is not distinct from g.source)
select doc_id, size, source_size, target,
  case when source_size = 0 then 0 else (budget // source_size) * size
    + least(greatest(budget - (budget // source_size) * source_size - start, 0), size) end::bigint as taken
from placed
"""


@query("op8_source_mix", MIX_SQL)
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = written(keyed(docs).select("doc_id", "source", "size", "_key"), "mix-keys")
    return mix(slim).select("doc_id", "size", "source_size", "target", "taken")
