"""op6: groups of near-duplicate documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm.jaccard import link_classes
from sensorlens.llm.registry import query, table


GROUPS_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
links as (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as c
    from grams x join grams y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2)
  join sizes s on s.doc_id = a join sizes t on t.doc_id = b
  where 100 * c >= 80 * (s.n + t.n - c)),
reached as (
  select doc_id as a, doc_id as b from documents
  union select r.a, l.b from reached r join links l on l.a = r.b)
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.c as component_id
from documents d left join sizes s using (doc_id)
join (select a, min(b) as c from reached group by a) r on r.a = d.doc_id
"""


@query("op6_jaccard_groups", GROUPS_SQL)
def op6_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(table(spark, sf_dir, "documents"))
