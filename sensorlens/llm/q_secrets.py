"""op1: secrets in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.llm.registry import query, table
from sensorlens.llm.secrets import BASE_KINDS, RULES, scan, written_spans


def _rule_sql(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return (
        f"select doc_id, {place} as k, '{kind}' as kind, string_split_regex(t, {p}) as g, "
        f"regexp_extract_all(t, {p}, 0) as m, regexp_extract_all(t, {p}, {group}) as v, {least} as least "
        f"from d where regexp_matches(t, {p})"
    )


SECRETS_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(_rule_sql(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(RULES))}),
each as (select *, unnest(range(1, len(m) + 1)) as i from found),
spans as (
  select doc_id, k, kind, (length(array_to_string(g[1:i], ''))
      + length(array_to_string(m[1:i-1], '')))::bigint as s, length(m[i]) as n
  from each where length(v[i]) >= least),
listed as (
  select doc_id, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access,
    count(*) filter (k = 2) as n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' order by s, k) filter (k < 3), '') as base,
    string_agg(kind || ':' || s || ':' || (s + n), ',' order by s, k) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join listed using (doc_id)
"""


@query("op1_secret_scan", SECRETS_SQL)
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)],
        F.sha2(written_spans(base), 256).alias("base_sha256"),
        written_spans(spans).alias("spans"),
    )
