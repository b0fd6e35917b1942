"""Queries over column profiles, quality checks and exploratory statistics."""

from __future__ import annotations


from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise, new_folder
from sensorlens.operators import profile as P
from sensorlens.operators.evaluate import top_k
from sensorlens.operators.order_stats import smallest_rows
from sensorlens.operators.split import BY_THRESHOLD, split_holdout
from sensorlens.plans.catalog import query
from sensorlens.plans.tables import WIDE, WIDE_SQL, X_SQL, XY_SQL, Y_SQL
from sensorlens.plans.tables import digest_sql, features_x, joined_xy, labels_y, table, wide_missing
from sensorlens.streaming.profile_stream import file_stream, profile_available_files


def rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


def per_column(body: str, columns=WIDE, source=WIDE_SQL) -> str:
    """One SELECT per column: ``{c}`` is the column, ``{i}`` its position."""
    parts = [f"select '{c}' as \"column\", {i} as ordinal, " + body.format(c=c, i=i) for i, c in enumerate(columns)]
    return f"with t as materialized (select * from {source}) " + " union all ".join(parts)


MOMENTS = """round(min({c})::double, 4) as "min", round(max({c})::double, 4) as "max",
 round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std"""


@query("a24_describe_numeric", per_column(
    """count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
 round(min({c})::double, 4) as "min", round(quantile_cont({c}::double, 0.25), 4) as p25,
 round(quantile_cont({c}::double, 0.5), 4) as p50, round(quantile_cont({c}::double, 0.75), 4) as p75,
 round(max({c})::double, 4) as "max" from t"""))
def a24_numeric(spark, sf_dir):
    d = P.describe(wide_missing(spark, sf_dir), numeric_only=True).drop("unique", "top", "freq")
    return rounded(d, "mean", "std", "min", "p25", "p50", "p75", "max")


def _values_sql(column: str, ordinal: int) -> str:
    blank = ", ".join(f"cast(null as double) as {n}" for n in ('mean', 'std', '"min"', 'p25', 'p50', 'p75', '"max"'))
    return f"""select '{column}' as "column", {ordinal} as ordinal, cast(sum(n) as bigint) as count,
 count(*) as "unique", arg_min(v, (-n, v)) as top, max(n) as freq, {blank}
 from (select cast({column} as varchar) as v, count(*) as n from events where {column} is not null group by 1)"""


def _numbers_sql(column: str, ordinal: int) -> str:
    return f"""select '{column}' as "column", {ordinal} as ordinal, count({column}) as count,
 cast(null as bigint) as "unique", cast(null as varchar) as top, cast(null as bigint) as freq,
 round(avg({column}), 4) as mean, round(stddev_samp({column}), 4) as std,
 round(min({column})::double, 4) as "min", round(quantile_cont({column}::double, 0.25), 4) as p25,
 round(quantile_cont({column}::double, 0.5), 4) as p50, round(quantile_cont({column}::double, 0.75), 4) as p75,
 round(max({column})::double, 4) as "max" from events"""


@query("a24_describe_all", " union all ".join([
    _numbers_sql("event_id", 0), _values_sql("ts", 1), _numbers_sql("user_id", 2),
    _values_sql("event_type", 3), _numbers_sql("value", 4), _values_sql("props", 5)]))
def a24_all(spark, sf_dir):
    d = P.describe(table(spark, sf_dir, "events"))
    return rounded(d, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("a25_min_max_mean_std", per_column(MOMENTS + " from t"))
def a25(spark, sf_dir):
    return rounded(P.min_max_mean_std(wide_missing(spark, sf_dir)), "min", "max", "mean", "std")


@query("a26_dtype_analysis", " union all ".join(
    f"""select '{c}' as "column", {i} as ordinal, '{t}' as dtype, count({c}) as non_missing from orders"""
    for i, (c, t) in enumerate([("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
     ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")])))
def a26(spark, sf_dir):
    return P.dtype_analysis(table(spark, sf_dir, "orders"))


CARDINALITY = """count(distinct {c}) + coalesce(max(cast({c} is null as integer)), 0) as "unique" from t"""


@query("a27_cardinality_count", per_column(CARDINALITY))
def a27(spark, sf_dir):
    return P.cardinality_count(wide_missing(spark, sf_dir))


MISSING = """count(*) - count({c}) as missing_count,
 round((count(*) - count({c}))::double / count(*), 6) as missing_ratio from t"""


@query("a28_null_count", per_column(MISSING))
def a28(spark, sf_dir):
    return P.null_count(wide_missing(spark, sf_dir))


POINTS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p99.9": 0.999}


@query("a29_percentile_analysis", per_column(", ".join(
    f'round(quantile_cont({{c}}::double, {p}), 4) as "{n}"' for n, p in POINTS.items()) + " from t"))
def a29(spark, sf_dir):
    table_ = P.percentile_analysis(wide_missing(spark, sf_dir))
    return table_.select("column", "ordinal", *[F.round(f"`{n}`", 4).alias(n) for n in POINTS])


@query("a29_percentiles_of_column", """select 'value' as "column", 0 as ordinal, """ + ", ".join(
    f'round(quantile_cont(value, {POINTS[n]}), 4) as "{n}"' for n in ("p1", "p5", "p95", "p99", "p99.9")) + " from events")
def a29_column(spark, sf_dir):
    t = P.percentile_analysis(table(spark, sf_dir, "events"), [0.01, 0.05, 0.95, 0.99, 0.999], ["value"])
    return t.select("column", "ordinal", *[F.round(f"`{n}`", 4).alias(n) for n in ("p1", "p5", "p95", "p99", "p99.9")])


def histogram_sql(bins: int) -> str:
    def part(i: int, c: str) -> str:
        return f"""select '{c}' as "column", {i} as ordinal, b.bin::integer as bin,
 round(lo + b.bin * w, 4) as lower, round(case when b.bin = {bins - 1} then hi else lo + (b.bin + 1) * w end, 4) as upper,
 coalesce(h.n, 0) as n
 from (select min({c})::double as lo, max({c})::double as hi, (max({c})::double - min({c})::double) / {bins} as w from t) e
 cross join range({bins}) as b(bin)
 left join (select least(floor(({c} - lo) / w), {bins - 1}) as bin, count(*) as n from t,
 (select min({c})::double as lo, (max({c})::double - min({c})::double) / {bins} as w from t)
 where {c} is not null group by 1) h on h.bin = b.bin"""

    return f"with t as materialized (select * from {WIDE_SQL}) " + " union all ".join(part(i, c) for i, c in enumerate(WIDE))


@query("a30_histograms", histogram_sql(30))
def a30(spark, sf_dir):
    return rounded(P.histograms(wide_missing(spark, sf_dir)), "lower", "upper")


@query("a31_label_distribution", "select nullif(o_orderstatus, 'P') as label, count(*) as n from orders group by 1")
def a31(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return P.label_distribution(orders, "status")


@query("a32_shape", "select count(*) as n_rows, 11 as n_columns from lineitem")
def a32(spark, sf_dir):
    return P.shape(table(spark, sf_dir, "lineitem"))


@query("a33_split_sizes", f"""with p as (select 0 as ordinal, 'train' as split, count(*) as n_rows, 3 as n_columns
 from {Y_SQL} where {digest_sql('id')} >= '33333333'
 union all select 1, 'test', count(*), 3 from {Y_SQL} where {digest_sql('id')} < '33333333')
 select ordinal, split, n_rows, n_columns, round(n_rows * 100.0::double / (select sum(n_rows) from p), 2) as percentage from p""")
def a33(spark, sf_dir):
    train, test = split_holdout(labels_y(spark, sf_dir), None, BY_THRESHOLD)
    return P.split_sizes({"train": train, "test": test})


def _stats_by_feature(df):
    """Moments in statistics-by-feature layout, as a describe table has them."""
    labels = {"count": F.count, "mean": F.avg, "min": F.min, "max": F.max}
    one = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for n, f in labels.items() for c in df.columns])
    rows = [F.struct(F.lit(n).alias("statistic"), *[F.col(f"{n}_{c}").alias(c) for c in df.columns]) for n in labels]
    return one.select(F.inline(F.array(*rows)))


@query("a34_features_as_rows", " union all ".join(
    f"""select '{c}' as "NameColumn", count({c})::double as count, round(avg({c}), 4) as mean,
 round(min({c})::double, 4) as "min", round(max({c})::double, 4) as "max" from {WIDE_SQL}""" for c in WIDE))
def a34(spark, sf_dir):
    t = P.features_as_rows(_stats_by_feature(wide_missing(spark, sf_dir)), "statistic")
    return rounded(t, "mean", "min", "max")


@query("a35_report_order", per_column("""count({c}) as n, count(*) - count({c}) as missing from t"""))
def a35(spark, sf_dir):
    return P.column_stats(wide_missing(spark, sf_dir)).orderBy("ordinal").select("column", "ordinal", "n", "missing")


@query("a39_top_cardinality", f"""select * from ({per_column(CARDINALITY)}) order by "unique" desc, ordinal limit 3""")
def a39(spark, sf_dir):
    return P.cardinality_count(wide_missing(spark, sf_dir), max_unique_to_report=3)


@query("a40_missing_sorted", f"select *, row_number() over (order by missing_ratio desc, ordinal) as position from ({per_column(MISSING)})")
def a40(spark, sf_dir):
    ordered = P.null_count(wide_missing(spark, sf_dir)).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("missing_ratio")).alias("k"), "ordinal", "column", "missing_count", "missing_ratio"))).alias("r"))
    rows = ordered.select(F.posexplode("r").alias("position", "r"))
    return rows.select((F.col("position") + 1).cast("long").alias("position"), "r.column", "r.ordinal", "r.missing_count", "r.missing_ratio")


IMPORTANCE_SQL = " union all ".join(
    f"select '{c}' as feature, round(abs(corr({c}, faulty)), 6) as importance from {XY_SQL}"
    for c in ("qty", "price", "disc", "tax", "n_lines"))


@query("a41_top_k_importance", f"select * from ({IMPORTANCE_SQL}) order by importance desc, feature limit 3")
def a41(spark, sf_dir):
    corr = P.correlation_matrix(joined_xy(spark, sf_dir).drop("margin"))
    strength = corr.filter("column_b = 'faulty'").select(
        F.col("column_a").alias("feature"), F.round(F.abs("corr"), 6).alias("importance"))
    return top_k(strength, 3)


@query("a42_row_cap", f"""select "column", ordinal, bin, n, true as truncated from ({histogram_sql(30)}) order by ordinal, bin limit 60""")
def a42(spark, sf_dir):
    report = P.histograms(wide_missing(spark, sf_dir)).select("column", "ordinal", "bin", "n")
    return P.row_cap(report, 60, ["ordinal", "bin"])


@query("a62_stream_profile", per_column(
    """count({c}) as n, count(*) - count({c}) as missing, round(min({c})::double, 4) as "min",
 round(max({c})::double, 4) as "max", round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std from t""",
    ["event_id", "user_id", "value"], "events"))
def a62(spark, sf_dir):
    """The events arrive in six files, two to a batch, so totals of batches are merged."""
    events = table(spark, sf_dir, "events")
    path = new_folder(spark, "arrivals")
    events.repartition(6).write.parquet(path)
    stream = file_stream(spark, path, events.schema, files_per_batch=2)
    profile = profile_available_files(stream, ["event_id", "user_id", "value"]).drop("missing_ratio")
    return rounded(profile, "min", "max", "mean", "std")


@query("b01_missing_analysis", f"select * from ({per_column(MISSING)}) order by missing_ratio desc, ordinal limit 30")
def b01(spark, sf_dir):
    return P.missing_analysis(wide_missing(spark, sf_dir), show_top_columns=30)


OUTLIERS = """round({lo}, 4) as lower, round({hi}, 4) as upper, count({c}) as n,
 count(*) filter ({c} < {lo} or {c} > {hi}) as outliers,
 round(count(*) filter ({c} < {lo} or {c} > {hi})::double / count({c}), 6) as outlier_ratio from t, """


def _outliers_sql(bounds: str) -> str:
    return per_column(OUTLIERS.replace("{lo}", "max_lo").replace("{hi}", "max_hi").replace("max_lo", "lo").replace("max_hi", "hi")
                      + bounds + " b group by lo, hi", ["qty", "price", "disc", "tax", "n_lines"], X_SQL)


@query("b02_outliers_iqr", _outliers_sql(
    """(select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from
 (select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.75) as q3 from t))"""))
def b02(spark, sf_dir):
    return rounded(P.outlier_detection(materialise(features_x(spark, sf_dir))), "lower", "upper")


@query("b03_outliers_zscore", _outliers_sql(
    "(select avg({c}) - 3 * stddev_samp({c}) as lo, avg({c}) + 3 * stddev_samp({c}) as hi from t)"))
def b03(spark, sf_dir):
    return rounded(P.outlier_detection(materialise(features_x(spark, sf_dir)), "zscore"), "lower", "upper")


def _duplicates_sql(columns: str, source: str) -> str:
    return f"""select cast(sum(copies) as bigint) as n_rows, count(*) as n_distinct,
 cast(sum(copies - 1) as bigint) as n_duplicates, max(copies) as largest_group
 from (select count(*) as copies from {source} group by {columns})"""


@query("b04_duplicate_rows", _duplicates_sql("text, lang, source", "documents"))
def b04(spark, sf_dir):
    return P.duplicate_detection(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query("b04_duplicate_subset", _duplicates_sql("l_orderkey, l_linenumber", "lineitem"))
def b04_subset(spark, sf_dir):
    return P.duplicate_detection(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("b05_range_validation", """select 0 as rule, 'l_quantity' as "column", count(l_quantity) as n,
 count(*) filter (l_quantity < 5) as below, count(*) filter (l_quantity > 45) as above,
 count(*) filter (l_quantity < 5 or l_quantity > 45) as violations from lineitem
 union all select 1, 'l_tax', count(l_tax), 0, count(*) filter (l_tax > 0.06::double), count(*) filter (l_tax > 0.06::double) from lineitem
 union all select 2, 'l_extendedprice', count(l_extendedprice), count(*) filter (l_extendedprice < 1000), 0,
 count(*) filter (l_extendedprice < 1000) from lineitem""")
def b05(spark, sf_dir):
    rules = [("l_quantity", 5.0, 45.0), ("l_tax", None, 0.06), ("l_extendedprice", 1000.0, None)]
    return P.range_validation(table(spark, sf_dir, "lineitem"), rules)


@query("b06_inconsistency_checks", f"""with t as (select * from {WIDE_SQL})
 select 'price_covers_quantity' as rule, count(*) as n_rows, count(*) filter (not (l_extendedprice >= 1000 * l_quantity)) as violations,
 count(*) filter ((l_extendedprice >= 1000 * l_quantity) is null) as undecided from t
 union all select 'discount_above_tax', count(*), count(*) filter (not (l_discount >= l_tax)), count(*) filter ((l_discount >= l_tax) is null) from t""")
def b06(spark, sf_dir):
    return P.inconsistency_checks(wide_missing(spark, sf_dir), {
        "price_covers_quantity": "l_extendedprice >= 1000 * l_quantity", "discount_above_tax": "l_discount >= l_tax"})


@query("b07_boxplots", per_column(
    """round(min({c})::double, 4) as "min", round(min({c}) filter ({c} between lo and hi)::double, 4) as whisker_low,
 round(q1, 4) as q1, round(q2, 4) as median, round(q3, 4) as q3,
 round(max({c}) filter ({c} between lo and hi)::double, 4) as whisker_high, round(max({c})::double, 4) as "max",
 count(*) filter (not ({c} between lo and hi)) as outliers
 from t, (select q1, q2, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from
 (select quantile_cont({c}::double, 0.25) as q1, quantile_cont({c}::double, 0.5) as q2, quantile_cont({c}::double, 0.75) as q3 from t)) b
 group by q1, q2, q3""", ["qty", "price", "disc", "tax", "n_lines"], X_SQL))
def b07(spark, sf_dir):
    return rounded(P.boxplots(materialise(features_x(spark, sf_dir))), "min", "whisker_low", "q1", "median", "q3", "whisker_high", "max")


def _pairs_sql(columns, source: str) -> str:
    return f"with t as materialized (select * from {source}) " + " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as corr from t"
        for i, a in enumerate(columns) for b in columns[i + 1 :])


@query("b08_correlation_pearson", _pairs_sql(WIDE, WIDE_SQL))
def b08(spark, sf_dir):
    return rounded(P.correlation_matrix(wide_missing(spark, sf_dir)), "corr", digits=6)


def _ranks_sql(columns, source: str) -> str:
    ranks = ", ".join(f"case when {c} is not null then rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0::double end as {c}" for c in columns)
    return f"(select {ranks} from {source})"


@query("b09_correlation_spearman", _pairs_sql(WIDE, _ranks_sql(WIDE, WIDE_SQL)))
def b09(spark, sf_dir):
    return rounded(P.correlation_matrix(wide_missing(spark, sf_dir), "spearman"), "corr", digits=6)


@query("b10_scatter_sample", f"select id, qty, price, disc, tax, n_lines from {X_SQL} order by {digest_sql('id', 42, 13)}, id limit 10000")
def b10(spark, sf_dir):
    return P.scatter_matrix(materialise(features_x(spark, sf_dir)), sample_rows=10_000)


@query("b11_pca_exploratory")
def b11(spark, sf_dir):
    return P.pca_exploratory(materialise(features_x(spark, sf_dir)), keep=["id"])


@query("b11_pca_two_columns", f"""with x as materialized (select id, qty, price from {X_SQL}),
 s as (select avg(qty) as mq, stddev_pop(qty) as sq, avg(price) as mp, stddev_pop(price) as sp from x)
 select id, round(abs((qty - mq) / sq + (price - mp) / sp) / sqrt(2), 6) as pc1, round(abs((qty - mq) / sq - (price - mp) / sp) / sqrt(2), 6) as pc2 from x, s""")
def b11_two(spark, sf_dir):
    pcs = P.pca_exploratory(materialise(features_x(spark, sf_dir)), cols=["qty", "price"], keep=["id"])
    return pcs.select("id", F.round(F.abs("pc1"), 6).alias("pc1"), F.round(F.abs("pc2"), 6).alias("pc2"))


@query("a02_sample_null_keys", """select id, "key" from (select o_orderkey as id, case when o_custkey % 3 > 0 then o_orderkey end as "key" from orders)
 order by "key" nulls first, id limit (select count(*) // 2 from orders)""")
def a02_null_keys(spark, sf_dir):
    """A sample that ends among the keyed rows, all rows without a key before them."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderkey")).alias("key"))
    return smallest_rows(orders, orders.count() // 2, "key")


@query("a02_sample_text_key", """select p_name from part order by p_name limit (select count(*) // 2 from part)""")
def a02_text_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name")
    return smallest_rows(parts, parts.count() // 2, "p_name")


@query("a02_smallest_by_key", "select l_orderkey from lineitem order by l_orderkey limit 20000")
def a02_threshold(spark, sf_dir):
    return smallest_rows(table(spark, sf_dir, "lineitem").select("l_orderkey"), 20_000, "l_orderkey")


