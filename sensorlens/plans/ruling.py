"""Queries of rules held in tables, of several groupings at once and of kernel machines."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.operators import families, model, profile, range_join, split
from sensorlens.plans.catalog import query
from sensorlens.plans.modelling import TEST, _predictions
from sensorlens.plans.tables import XY_SQL, digest_sql, joined_xy, table

# Every part is a rule on the values of events of one type: some narrow, some wide, some open above or below.
_RULES_SQL = """(select p_partkey as rule, list_extract(['click', 'error', 'purchase', 'signup', 'view'], (p_partkey % 5 + 1)::int) as event_type,
 case when p_partkey % 7 <> 0 then p_retailprice / 20 end as low,
 case when p_partkey % 11 <> 0 then p_retailprice / 20 + p_size * case when p_partkey % 3 = 0 then 0.01 else 1 end end as high from part)"""


def _rules(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    key, price = F.col("p_partkey"), F.col("p_retailprice") / 20
    wide = F.col("p_size") * F.when(key % 3 == 0, F.lit(0.01)).otherwise(F.lit(1.0))
    return table(spark, sf_dir, "part").select(
        key.alias("rule"), kinds[(key % 5).cast("int")].alias("event_type"),
        F.when(key % 7 != 0, price).alias("low"), F.when(key % 11 != 0, price + wide).alias("high"))


@query("b05_rule_matches", f"""select rule, count(*) as n, count(distinct event_id) as n_events, max(value) as high_value
 from events join {_RULES_SQL} r on r.event_type = events.event_type and value >= coalesce(low, -1e300) and value <= coalesce(high, 1e300) group by 1""")
def b05_matches(spark, sf_dir):
    found = range_join.rule_counts(table(spark, sf_dir, "events"), _rules(spark, sf_dir), "value", "rule", "low", "high", ["event_type"], "event_id")
    return found.select("rule", "n", F.col("n_distinct").alias("n_events"), F.col("highest").alias("high_value"))


@query("b05_rule_violations", f"""select rule, r.event_type, count(value) as n, count(value) - count(*) filter (value between coalesce(low, -1e300) and coalesce(high, 1e300)) as outside,
 round((count(value) - count(*) filter (value between coalesce(low, -1e300) and coalesce(high, 1e300)))::double / nullif(count(value), 0), 6) as outside_ratio
 from {_RULES_SQL} r left join events on r.event_type = events.event_type group by 1, 2""")
def b05_violations(spark, sf_dir):
    found = range_join.rule_violations(table(spark, sf_dir, "events"), _rules(spark, sf_dir), "value", "rule", "low", "high", ["event_type"])
    return found.withColumn("outside_ratio", F.round("outside_ratio", 6))


EDGES = [0.0, 50_000.0, 100_000.0, 200_000.0, 400_000.0]
_BIN = " ".join(f"when price >= {a} and price < {b} then {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:])))
SETS = [["faulty", "part", "bin"], ["faulty", "bin"], ["part"], ["bin"], []]


@query("a30_grouping_sets", f"""with t as (select faulty, case when {TEST} then 'test' else 'train' end as part, price, (case {_BIN} end)::int as bin from {XY_SQL})
 select faulty, part, bin, grouping(faulty, part, bin)::bigint as grouping, count(*) as n, round(avg(price), 2) as mean, min(price) as "min", max(price) as "max"
 from t group by grouping sets ((faulty, part, bin), (faulty, bin), (part), (bin), ())""")
def a30_sets(spark, sf_dir):
    held = split.holdout_side(joined_xy(spark, sf_dir), None, split.BY_THRESHOLD)
    rows = held.withColumn("part", F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")))
    found = profile.grouped_counts(rows, "price", ["faulty", "part"], EDGES, SETS)
    return found.withColumn("mean", F.round("mean", 2))


@query("b57_rbf_svm")
def b57_rbf(spark, sf_dir):
    return _predictions(spark, sf_dir, "svm_classifier", {"kernel": "rbf", "C": 10.0}, model.CLASSIFIERS)


@query("b67_family_fit")
def b67_families(spark, sf_dir):
    return families.choose_family(table(spark, sf_dir, "events"), "value", "event_id")[1]


@query("b67_normal_likelihood", f"""with e as (select value, {digest_sql('event_id')} < '33333333' as held from events),
 f as (select avg(value) as m, stddev_pop(value) as s, count(value) as n from e where not held)
 select 'norm' as family, round(m, 6) as loc, round(s, 6) as scale, round(avg(-0.5 * ln(2 * pi()) - ln(s) - ((value - m) / s) ** 2 / 2), 6) as log_likelihood,
 n as n_train, count(value) as n_held from e, f where held group by m, s, n""")
def b67_normal(spark, sf_dir):
    report = families.choose_family(table(spark, sf_dir, "events"), "value", "event_id", ["norm"])[1].drop("shape")
    return report.withColumns({c: F.round(c, 6) for c in ("loc", "scale", "log_likelihood")})
