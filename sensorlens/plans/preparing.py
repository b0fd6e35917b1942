"""Queries over joins, selection, splits, cleaning, encoding, scaling and integration."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators import clean, encode, engineer, integrate, keys, prep, select, split
from sensorlens.plans.catalog import query
from sensorlens.plans.tables import FEATURES, X_MISSING_SQL, X_SQL, XY_SQL, Y_SQL, WIDE_SQL
from sensorlens.plans.tables import digest_sql, features_x, joined_xy, labels_y, table
from sensorlens.plans.tables import wide_missing, x_missing

TEST = f"({digest_sql('id')} < '33333333')"
X_COLUMNS = "id, qty, price, disc, tax, n_lines"


def rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- joins and keys --------------------------------------------------------------------


@query("a19_inner_join_x_y", f"select {X_COLUMNS}, faulty, margin from {XY_SQL}")
def a19(spark, sf_dir):
    return keys.inner_join_x_y(features_x(spark, sf_dir), labels_y(spark, sf_dir), "id")


@query("a19_join_hot_keys", """select l.l_partkey as part, l.l_quantity as quantity, p.p_brand as brand
 from lineitem l join part p on l.l_partkey = p.p_partkey""")
def a19_hot(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand"))
    return keys.inner_join_x_y(lines, parts, "part", hot_share=0.01)


@query("a19_join_null_safe", """select nullif(d.doc_id, 3) as doc_id, d.lang, l.quality from documents d
 join labels l on nullif(d.doc_id, 3) is not distinct from nullif(l.doc_id, 3)""")
def a19_null_safe(spark, sf_dir):
    key = F.nullif("doc_id", F.lit(3)).alias("doc_id")
    docs = table(spark, sf_dir, "documents").select(key, "lang")
    labels = table(spark, sf_dir, "labels").select(key, "quality")
    return keys.inner_join_x_y(docs, labels, "doc_id", null_safe=True)


@query("a20_one_to_one_join", """select d.doc_id, d.lang, d.source, l.quality, l.toxic
 from documents d join labels l on d.doc_id = l.doc_id""")
def a20(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return keys.one_to_one_join(docs, table(spark, sf_dir, "labels"), "doc_id")


@query("a21_duplicate_keys", """select cast(sum(n) as bigint) as n_rows, count(*) as n_keys,
 cast(sum(n - 1) as bigint) as duplicate_rows from (select count(*) as n from lineitem group by l_orderkey)""")
def a21(spark, sf_dir):
    return keys.duplicate_key_count(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("a22_row_parity", f"""select count(x.id) as rows_x, count(y.id) as rows_y, count(x.id) = count(y.id) as same_rows,
 count(*) filter (x.id is not null and y.id is not null) as keys_matched,
 count(*) filter (y.id is null) as keys_only_x, count(*) filter (x.id is null) as keys_only_y
 from {X_SQL} x full join {Y_SQL} y on x.id = y.id""")
def a22(spark, sf_dir):
    return keys.row_parity(features_x(spark, sf_dir), labels_y(spark, sf_dir), "id")


# Column descriptions and the texts shown for columns without one.
LEGEND = {
    "id": {"en": "Order number", "it": "Numero dell'ordine"},
    "qty": {"en": "Quantity summed over the order", "it": "Quantità totale dell'ordine"},
    "price": {"en": "Price summed over the order", "it": "Prezzo totale dell'ordine"},
}


def _legend_sql() -> str:
    parts = []
    for i, c in enumerate(X_COLUMNS.split(", ")):
        en = LEGEND.get(c, {}).get("en", "(missing description)")
        it = LEGEND.get(c, {}).get("it", "(descrizione mancante)").replace("'", "''")
        parts.append(f"""select '{c}' as "column", {i} as ordinal, '{en}' as en, '{it}' as it, count({c}) as n from {X_SQL}""")
    return " union all ".join(parts)


@query("a23_column_legend", _legend_sql())
def a23(spark, sf_dir):
    return keys.column_legend(features_x(spark, sf_dir), LEGEND, ("en", "it"), {"it": "(descrizione mancante)"})


@query("b46_dataset_merging", f"select y.id, y.faulty, y.margin, x.qty, x.price from {Y_SQL} y left join {X_SQL} x on x.id = y.id")
def b46(spark, sf_dir):
    x = features_x(spark, sf_dir).select("id", "qty", "price")
    return integrate.dataset_merging(labels_y(spark, sf_dir), x, ["id"], "left")


@query("b47_union_concat", f"""select id, faulty, margin, cast(null as double) as price from {Y_SQL}
 union all select id, null, null, price from {X_SQL}""")
def b47(spark, sf_dir):
    return integrate.union_concat([labels_y(spark, sf_dir), features_x(spark, sf_dir).select("id", "price")])


@query("b48_column_renaming", f"select id as sample, faulty as broken, margin from {Y_SQL}")
def b48(spark, sf_dir):
    return integrate.column_renaming(labels_y(spark, sf_dir), {"id": "sample", "faulty": "broken"})


@query("b49_datatype_harmonization", """select c_custkey as id, c_nationkey::bigint as place, c_acctbal as amount, c_mktsegment as kind from customer
 union all select p_partkey, null, p_size::double, p_type from part
 union all select s_suppkey, s_nationkey, s_acctbal, s_suppkey::varchar from supplier""")
def b49(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("place"),
        F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("kind"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("amount"), F.col("p_type").alias("kind"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("place"),
        F.col("s_acctbal").alias("amount"), F.col("s_suppkey").alias("kind"))
    return integrate.union_concat(integrate.datatype_harmonization([customers, parts, suppliers]))


@query("b50_pk_fk_mapping", """select o_orderkey, o_totalprice, c_custkey, c_mktsegment from orders join customer on o_custkey = c_custkey""")
def b50(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return integrate.pk_fk_mapping(orders, customers, {"o_custkey": "c_custkey"})


@query("b50_orphan_rows", "select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)")
def b50_orphans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return integrate.orphan_rows(docs, table(spark, sf_dir, "labels"), {"doc_id": "doc_id"})


@query("b51_priority_rules", f"""select coalesce(a.id, b.id) as id, coalesce(a.qty, b.qty) as qty, coalesce(b.amount, a.amount) as amount
 from (select id, qty, price as amount from {X_MISSING_SQL}) a
 full join (select o_orderkey as id, 1.0::double as qty, case when o_orderstatus <> 'P' then o_totalprice end as amount from orders) b on a.id = b.id""")
def b51(spark, sf_dir):
    lines = x_missing(spark, sf_dir).select("id", "qty", F.col("price").alias("amount"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit(1.0).alias("qty"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"))
    rules = {"amount": ["orders", "lines"]}
    return integrate.priority_rules({"lines": lines, "orders": orders}, "id", rules)


@query("b52_data_enrichment", """select l_partkey, l_quantity, p_brand, p_size from lineitem left join part on l_partkey = p_partkey""")
def b52(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    return integrate.data_enrichment(lines, parts, "l_partkey", ["p_brand", "p_size"])


# --- selection -------------------------------------------------------------------------


def _padded_x(spark, sf_dir):
    """Features with a constant, an all-missing, a nearly constant and two copied columns."""
    return materialise(features_x(spark, sf_dir)).withColumns({
        "fixed": F.lit(5.0), "void": F.lit(None).cast("double"), "flag": (F.col("n_lines") > 3).cast("int"),
        "qty_again": F.col("qty"), "qty_moved": F.col("qty") + F.lit(1.0), "lines_again": F.col("n_lines")})


PADDED_SQL = f"""(select *, 5.0::double as fixed, cast(null as double) as void, cast(n_lines > 3 as integer) as flag,
 qty as qty_again, qty + 1 as qty_moved, n_lines as lines_again from {X_SQL})"""


@query("a36_before_after_kpi", f"""select '3.1 constant' as step, count(*) as rows_before, 12 as cols_before,
 count(*) as rows_after, 10 as cols_after, 2 as cols_removed, 0 as cols_added from {PADDED_SQL}""")
def a36(spark, sf_dir):
    before = _padded_x(spark, sf_dir)
    after = select.remove_constant_features(before, [c for c in before.columns if c != "id"]).df
    return select.before_after_kpi(before, after, "3.1 constant")


CHANGES_SQL = f"""select step, change, "column" from (values
 ('3.1 constant', 'removed', 'fixed'), ('3.1 constant', 'removed', 'void')) v(step, change, "column")
 where (select count(distinct fixed) from {PADDED_SQL}) = 1 and (select count(void) from {PADDED_SQL}) = 0"""
DUPLICATE_CHANGES_SQL = f"""select step, change, "column" from (values
 ('3.1 duplicate', 'removed', 'lines_again'), ('3.1 duplicate', 'removed', 'qty_again')) v(step, change, "column")
 where (select bool_and(qty = qty_again and n_lines = lines_again) from {PADDED_SQL})"""


@query("a37_before_after_changes", CHANGES_SQL)
def a37(spark, sf_dir):
    before = _padded_x(spark, sf_dir)
    after = select.remove_constant_features(before).df
    return select.before_after_changes(before, after, "3.1 constant")


@query("a38_concat_reports", f"{CHANGES_SQL} union all {DUPLICATE_CHANGES_SQL}")
def a38(spark, sf_dir):
    before = _padded_x(spark, sf_dir)
    constant = select.remove_constant_features(before).df
    duplicate = select.remove_duplicate_features(constant).df
    return select.concat_reports([
        select.before_after_changes(before, constant, "3.1 constant"),
        select.before_after_changes(constant, duplicate, "3.1 duplicate")])


@query("a43_remove_constant", f"select * exclude (fixed, void) from {PADDED_SQL}")
def a43(spark, sf_dir):
    return select.remove_constant_features(_padded_x(spark, sf_dir)).df


@query("a43_remove_near_constant", f"select * exclude (fixed, void, flag) from {PADDED_SQL}")
def a43_near(spark, sf_dir):
    return select.remove_constant_features(_padded_x(spark, sf_dir), threshold_unique=2).df


@query("a44_remove_duplicate_features", f"select * exclude (qty_again, lines_again) from {PADDED_SQL}")
def a44(spark, sf_dir):
    return select.remove_duplicate_features(_padded_x(spark, sf_dir)).df


@query("b12_manual_include_exclude", f"select id, qty, tax from {X_SQL}")
def b12(spark, sf_dir):
    return select.manual_include_exclude(features_x(spark, sf_dir), ["id", "qty", "price", "tax"], ["price"])


@query("b13_drop_technical_columns", "select n_chars, lang, source from documents")
def b13(spark, sf_dir):
    return select.drop_technical_columns(table(spark, sf_dir, "documents").drop("text"), ["id", "uuid", "log"])


@query("b14_population_filtering", f"select {X_COLUMNS} from {X_SQL} where price > 50000 and n_lines between 2 and 6")
def b14(spark, sf_dir):
    return select.population_filtering(features_x(spark, sf_dir), ["price > 50000", "n_lines between 2 and 6"])


@query("b15_time_window_selection", """select event_id, event_type, value from events
 where ts >= timestamp '2024-01-03 00:00:00' and ts < timestamp '2024-01-20 12:00:00'""")
def b15(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    inside = select.time_window_selection(events, "ts", "2024-01-03 00:00:00", "2024-01-20 12:00:00")
    return inside.select("event_id", "event_type", "value")


@query("b16_semantic_based_selection", f"select id, qty, price, faulty from {XY_SQL}")
def b16(spark, sf_dir):
    return select.semantic_based_selection(joined_xy(spark, sf_dir), ["qty", "price"], "faulty")


@query("b17_business_rule_filtering", "select l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus from lineitem")
def b17(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return select.business_rule_filtering(lines, include=["l_linestatus"], exclude=["l_line.*", "l_ship.*", "l_tax"])


# --- splits ----------------------------------------------------------------------------


def _test_counts_sql(share: float) -> str:
    """Test rows per class of faulty by largest remainder; p holds the rows."""
    n_train = f"(total - ceil(round(total * {share}::double, 9)))"
    return f"""select label, n - floor(n * {n_train} / total) - cast(row_number() over (
   order by floor(n * {n_train} / total) - n * {n_train} / total, cast(label as varchar))
   <= {n_train} - sum(floor(n * {n_train} / total)) over () as integer) as k
  from (select faulty as label, count(*) as n, sum(count(*)) over () as total from p group by 1)"""


def _many_classes_sql() -> str:
    rows = "(select o_orderkey as id, cast(floor(o_totalprice / 100) as bigint) as class from orders)"
    counts = _test_counts_sql(0.2)
    return f"""with p as (select id, class as faulty from {rows}), t as ({counts}),
 r as (select *, row_number() over (partition by faulty order by {digest_sql('id', 42, 13)}, id) as r from p)
 select id, faulty as class, r <= k as is_test from r join t on t.label = faulty"""


def _exact_sql(label: str) -> str:
    return f"""with t as (select *, row_number() over (partition by {label} order by {digest_sql('id', 42, 13)}, id) as r from {Y_SQL}),
 c as (select {label} as label, count(*) as n, sum(count(*)) over () as total from t group by {label}),
 s as (select *, n * (total - ceil(round(total * 0.2::double, 9))) / total as share from c),
 f as (select *, floor(share) as whole, row_number() over (order by floor(share) - share, cast(label as varchar)) as turn,
  (total - ceil(round(total * 0.2::double, 9))) - sum(floor(share)) over () as rest from s)
 select id, faulty, r <= n - whole - cast(turn <= rest as integer) as is_test from t join f on t.{label} = f.label"""


@query("a45_stratified_holdout", _exact_sql("faulty"))
def a45(spark, sf_dir):
    return split.holdout_side(labels_y(spark, sf_dir), "faulty").drop("margin")


@query("a45_threshold_holdout", f"select id, faulty, {TEST} as is_test from {Y_SQL}")
def a45_threshold(spark, sf_dir):
    return split.holdout_side(labels_y(spark, sf_dir), None, split.BY_THRESHOLD).drop("margin")


@query("a45_stratified_exact", _exact_sql("faulty"))
def a45_exact(spark, sf_dir):
    exact = split.HoldoutConfig(exact=True)
    return split.holdout_side(labels_y(spark, sf_dir), "faulty", exact).drop("margin")


@query("a45_many_classes", _many_classes_sql())
def a45_many(spark, sf_dir):
    """More classes than a filter can list: the priced part of each line stands for its class."""
    lines = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.floor(F.col("o_totalprice") / 100).cast("long").alias("class")
    )
    return split.holdout_side(lines, "class")


@query("a46_plain_holdout", f"""select id, faulty, row_number() over (order by {digest_sql('id', 7, 13)}, id)
 <= ceil(round(count(*) over () * 0.25::double, 9)) as is_test from {Y_SQL}""")
def a46(spark, sf_dir):
    plain = split.HoldoutConfig(test_size=0.25, random_state=7, stratify=False, exact=True)
    return split.holdout_side(labels_y(spark, sf_dir), None, plain).drop("margin")


@query("b53_train_val_test", f"""with p as (select id, faulty, {digest_sql('id', 42, 13)} as d from {Y_SQL}),
 t as ({_test_counts_sql(0.2)}), u as ({_test_counts_sql(0.3)}),
 r as (select *, row_number() over (partition by faulty order by d, id) as r from p)
 select id, faulty, case when r <= t.k then 'test' when r <= u.k then 'val' else 'train' end as part
 from r join t on t.label = faulty join u on u.label = faulty""")
def b53(spark, sf_dir):
    parts = split.train_val_test(labels_y(spark, sf_dir), 0.1, 0.2, label="faulty")
    return parts.drop("margin")


@query("b53_threshold_parts", f"""select id, faulty, case when {digest_sql('id')} < '33333333' then 'test'
 when {digest_sql('id')} < '4ccccccd' then 'val' else 'train' end as part from {Y_SQL}""")
def b53_threshold(spark, sf_dir):
    return split.train_val_test(labels_y(spark, sf_dir), 0.1, 0.2).drop("margin")


@query("b54_temporal_split", """select event_id, value, ts >= (select ts from events order by ts
 offset (select cast(floor(count(*) * 0.8::double) as bigint) from events) limit 1) as is_test from events""")
def b54(spark, sf_dir):
    return split.temporal_split(table(spark, sf_dir, "events"), "ts", 0.2).select("event_id", "value", "is_test")


@query("b55_walk_forward", "with c as (select list(ts order by ts) as l, count(*) as n from events) select event_id, value, "
       + " + ".join(f"cast(ts >= l[1 + cast(floor(n * ({k}::double / 6)) as bigint)] as integer)" for k in range(1, 6))
       + " as block from events, c")
def b55(spark, sf_dir):
    return split.walk_forward(table(spark, sf_dir, "events"), "ts", 5).select("event_id", "value", "block")


# --- imputation and scaling, fitted on training rows ------------------------------------


def _train_and_all(spark, sf_dir):
    x = materialise(x_missing(spark, sf_dir))
    return split.split_holdout(x, None, split.BY_THRESHOLD)[0], x


def _prepared_sql(centre: str, scaling: bool = True) -> str:
    """Fill and scale every feature with figures of the training rows."""
    fills = ", ".join(f"{centre.format(c=c)} as fill_{c}" for c in FEATURES)
    moments = ", ".join(
        f"avg(coalesce({c}, fill_{c})) as mean_{c}, stddev_pop(coalesce({c}, fill_{c})) as sd_{c}" for c in FEATURES)
    if scaling:
        out = ", ".join(f"round((coalesce({c}, fill_{c}) - mean_{c}) / sd_{c}, 6) as {c}" for c in FEATURES)
    else:
        out = ", ".join(f"coalesce({c}, fill_{c})::double as {c}" for c in FEATURES)
    return f"""with x as materialized (select * from {X_MISSING_SQL}), tr as (select * from x where not {TEST}),
 f as (select {fills} from tr), m as (select {moments} from tr, f) select id, {out} from x, f, m"""


MEDIAN = "quantile_cont({c}::double, 0.5)"


@query("a47_median_imputation", _prepared_sql(MEDIAN, scaling=False))
def a47(spark, sf_dir):
    train, x = _train_and_all(spark, sf_dir)
    return prep.fit_numeric_preprocessor(train, FEATURES, prep.PreprocessConfig("median", "none")).transform(x, ["id"])


@query("a48_mean_imputation", _prepared_sql("round(avg({c}), 9)", scaling=False).replace("coalesce(qty, fill_qty)::double", "round(coalesce(qty, fill_qty), 6)").replace("coalesce(disc, fill_disc)::double", "round(coalesce(disc, fill_disc), 6)"))
def a48(spark, sf_dir):
    train, x = _train_and_all(spark, sf_dir)
    filled = prep.fit_numeric_preprocessor(train, FEATURES, prep.PreprocessConfig("mean", "none")).transform(x, ["id"])
    return rounded(filled, "qty", "disc", digits=6)


@query("a49_standard_scaling", _prepared_sql(MEDIAN))
def a49(spark, sf_dir):
    train, x = _train_and_all(spark, sf_dir)
    scaled = prep.fit_numeric_preprocessor(train, FEATURES).transform(x, ["id"])
    return rounded(scaled, *FEATURES, digits=6)


@query("a50_no_scaling", _prepared_sql(MEDIAN, scaling=False))
def a50(spark, sf_dir):
    train, x = _train_and_all(spark, sf_dir)
    cfg = prep.PreprocessConfig(scaling="none")
    vectors = prep.fit_numeric_preprocessor(train, FEATURES, cfg).assemble(x)
    values = prep.array_conversion(vectors, "features", "v")
    return values.select("id", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(FEATURES)])


@query("a51_feature_vectors", f"select id, [tax, price, qty] as features from ({_prepared_sql(MEDIAN)})")
def a51(spark, sf_dir):
    train, x = _train_and_all(spark, sf_dir)
    vectors = prep.fit_numeric_preprocessor(train, ["tax", "price", "qty"]).assemble(x)
    values = prep.array_conversion(vectors.select("id", "features"))
    return values.withColumn("features", F.transform("features", lambda v: F.round(v, 6)))


@query("b21_impute_in_place", f"select id, coalesce(qty, (select quantile_cont(qty, 0.5) from {X_MISSING_SQL})) as qty, price, disc, tax, n_lines from {X_MISSING_SQL}")
def b21(spark, sf_dir):
    return prep.impute_columns(x_missing(spark, sf_dir), ["qty"], "median")


def _scaled_sql(expression: str) -> str:
    out = ", ".join(f"round({expression.format(c=c)}, 6) as {c}" for c in ("qty", "price", "disc"))
    stats = ", ".join(
        f"""min({c})::double as lo_{c}, max({c})::double as hi_{c}, max(abs({c}))::double as top_{c}, quantile_cont({c}, 0.25) as q1_{c},
 quantile_cont({c}, 0.5) as q2_{c}, quantile_cont({c}, 0.75) as q3_{c}""" for c in ("qty", "price", "disc"))
    return f"""with x as materialized (select * from {X_MISSING_SQL}), s as (select {stats} from x where not {TEST})
 select id, {out} from x, s"""


def _scaled(spark, sf_dir, method):
    train, x = _train_and_all(spark, sf_dir)
    names = ["qty", "price", "disc"]
    return rounded(prep.scale_columns(x.select("id", *names), names, method, train), *names, digits=6)


@query("b35_minmax_scaling", _scaled_sql("({c} - lo_{c}) / (hi_{c} - lo_{c})"))
def b35(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query("b36_robust_scaling", _scaled_sql("({c} - q2_{c}) / (q3_{c} - q1_{c})"))
def b36(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@query("b37_maxabs_scaling", _scaled_sql("{c} / top_{c}"))
def b37(spark, sf_dir):
    return _scaled(spark, sf_dir, "maxabs")


@query("b56_type_casting", "select round(c_acctbal)::bigint as balance, c_custkey::varchar as id, try_cast(c_name as integer) as name from customer")
def b56(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.round("c_acctbal").alias("balance"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return prep.type_casting(customers, {"balance": "long", "id": "string", "name": "int"})


@query("b56_sparse_format", """select l_orderkey, l_linenumber, [v for v, i in [l_quantity, l_discount, l_tax] if v <> 0] as vals,
 [cast(i - 1 as integer) for v, i in [l_quantity, l_discount, l_tax] if v <> 0] as indices from lineitem""")
def b56_sparse(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    entries = prep.sparse_dense_format(lines, ["l_quantity", "l_discount", "l_tax"], "sparse")
    return entries.select("l_orderkey", "l_linenumber", F.col("entries.value").alias("vals"), F.col("entries.index").alias("indices"))


# --- cleaning --------------------------------------------------------------------------


@query("b18_drop_rows", f"select * from {WIDE_SQL} where l_quantity is not null and l_tax is not null")
def b18(spark, sf_dir):
    return clean.drop_rows(wide_missing(spark, sf_dir))


@query("b19_drop_columns", "select o_orderkey, o_totalprice, nullif(o_orderstatus, 'P') as status from orders")
def b19(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("customer"))
    return clean.drop_columns(orders, 0.5)


@query("b20_drop_rows_threshold", f"select qty, disc from {X_MISSING_SQL} where cast(qty is null as integer) + cast(disc is null as integer) <= 1")
def b20(spark, sf_dir):
    return clean.drop_rows_threshold(x_missing(spark, sf_dir).select("qty", "disc"), 0.5)


@query("b22_mode_imputation", """with t as (select o_orderkey, nullif(o_orderstatus, 'P') as status, case when o_custkey % 3 > 0 then o_orderpriority end as priority from orders)
 select o_orderkey, coalesce(status, (select status from t where status is not null group by 1 order by count(*) desc, status limit 1)) as status,
 coalesce(priority, (select priority from t where priority is not null group by 1 order by count(*) desc, priority limit 1)) as priority from t""")
def b22(spark, sf_dir):
    return encode.mode_imputation(_orders_missing(spark, sf_dir), ["status", "priority"])


def _orders_missing(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderpriority")).alias("priority"))


@query("b23_constant_imputation", """select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'missing') as status,
 case when o_custkey % 3 > 0 then o_orderpriority else 'missing' end as priority from orders""")
def b23(spark, sf_dir):
    return encode.constant_imputation(_orders_missing(spark, sf_dir), ["status", "priority"], "missing")


@query("b24_iterative_imputation")
def b24(spark, sf_dir):
    return clean.iterative_imputation(x_missing(spark, sf_dir), FEATURES, rounds=2)


@query("b24_impute_by_regression", f"""with x as materialized (select id, qty, price from {X_MISSING_SQL}),
 f as (select regr_slope(qty, price) as b, regr_intercept(qty, price) as a from x where qty is not null)
 select id, round(coalesce(qty, a + b * price), 3) as qty, price from x, f""")
def b24_line(spark, sf_dir):
    x = materialise(x_missing(spark, sf_dir).select("id", "qty", "price"))
    return rounded(clean.iterative_imputation(x, ["qty", "price"], rounds=1, reg_param=0.0), "qty", digits=3)


def _clipped_sql(lo: str, hi: str) -> str:
    stats = ", ".join(f"{lo.format(c=c)} as lo_{c}, {hi.format(c=c)} as hi_{c}" for c in ("qty", "price"))
    out = ", ".join(f"round(case when {c} is not null then greatest(least({c}, hi_{c}), lo_{c}) end, 6) as {c}" for c in ("qty", "price"))
    return f"with x as (select * from {X_MISSING_SQL}), s as (select {stats} from x) select id, {out} from x, s"


@query("b25_winsorization", _clipped_sql("quantile_cont({c}, 0.01)", "quantile_cont({c}, 0.99)"))
def b25(spark, sf_dir):
    x = materialise(x_missing(spark, sf_dir).select("id", "qty", "price"))
    return rounded(clean.winsorization(x, ["qty", "price"]), "qty", "price", digits=6)


@query("b26_iqr_clipping", _clipped_sql(
    "(quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)))",
    "(quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)))"))
def b26(spark, sf_dir):
    x = materialise(x_missing(spark, sf_dir).select("id", "qty", "price"))
    return rounded(clean.iqr_clipping(x, ["qty", "price"]), "qty", "price", digits=6)


@query("b27_zscore_filtering", f"""with x as (select id, qty, price from {X_MISSING_SQL}),
 s as (select avg(qty) as mq, stddev_samp(qty) as sq, avg(price) as mp, stddev_samp(price) as sp from x)
 select id, qty, price from x, s where coalesce(abs((qty - mq) / sq) <= 3, true) and coalesce(abs((price - mp) / sp) <= 3, true)""")
def b27(spark, sf_dir):
    return clean.zscore_filtering(x_missing(spark, sf_dir).select("id", "qty", "price"), ["qty", "price"])


@query("b28_log_transform", """select c_custkey, round(ln(1 + c_acctbal - least((select min(c_acctbal) from customer), 0)), 6) as c_acctbal from customer""")
def b28(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(clean.log_transform(customers, ["c_acctbal"]), "c_acctbal", digits=6)


def _power_sql(value: str, shape: str, changed: str, source: str, key: str, domain: str = "true") -> str:
    return f"""with t as (select {key} as id, {value} as v from {source}),
 g as (select (i - 20) / 10.0::double as lam from range(41) r(i)),
 s as (select lam, round((lam - 1) * any_value(shape) - 0.5 * ln(var_pop({changed})), 12) as score
  from (select lam, v, shape from t, g, (select avg({shape}) as shape from t)) group by lam),
 b as (select lam from s order by score desc, abs(lam - 1), lam limit 1)
 select id, lam, round({changed}, 6) as v from t, b"""


@query("b29_box_cox", _power_sql("price", "ln(v)", "case when lam = 0 then ln(v) else (pow(v, lam) - 1) / case when lam = 0 then 1 else lam end end", X_SQL, "id"))
def b29(spark, sf_dir):
    x = materialise(features_x(spark, sf_dir).select("id", F.col("price").alias("v")))
    lam = clean.fit_power(x, ["v"], "box_cox")
    return rounded(clean.box_cox(x, ["v"], lam), "v", digits=6).withColumn("lam", F.lit(float(lam["v"])))


YEO = """case when v >= 0 then case when lam = 0 then ln(1 + v) else (pow(v + 1, lam) - 1) / case when lam = 0 then 1 else lam end end
 else case when lam = 2 then -ln(1 - v) else -(pow(1 - v, 2 - lam) - 1) / case when lam = 2 then 1 else 2 - lam end end end"""


@query("b30_yeo_johnson", _power_sql("c_acctbal / 1000", "sign(v) * ln(1 + abs(v))", YEO, "customer", "c_custkey"))
def b30(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 1000).alias("v"))
    lam = clean.fit_power(c, ["v"], "yeo_johnson")
    return rounded(clean.yeo_johnson(c, ["v"], lam), "v", digits=6).withColumn("lam", F.lit(float(lam["v"])))


@query("b31_fix_typos", r"""select p_partkey, trim(regexp_replace(lower(p_name), '[^\p{L}\p{N}]+', ' ', 'g')) as p_name,
 trim(regexp_replace(lower(p_brand), '[^\p{L}\p{N}]+', ' ', 'g')) as p_brand from part""")
def b31(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return clean.fix_typos(parts, ["p_name", "p_brand"])


@query("b32_text_normalization", "select doc_id, trim(lower(strip_accents(text))) as text from documents")
def b32(spark, sf_dir):
    return clean.text_normalization(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])


@query("b33_rare_grouping", """with c as (select p_name, count(*) as n, sum(count(*)) over () as total from part group by 1)
 select p_partkey, case when n >= 0.04::double * total then p_name else 'Other' end as p_name from part join c using (p_name)""")
def b33(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return encode.rare_grouping(parts, "p_name", min_freq=0.04)


@query("b34_exact_duplicates", "select distinct text, lang, source, n_chars from documents")
def b34(spark, sf_dir):
    return clean.exact_duplicates(table(spark, sf_dir, "documents").drop("doc_id"))


@query("b34_keep_first", "select min(doc_id) as doc_id, text from documents group by text")
def b34_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean.exact_duplicates(docs, ["text"], order_by="doc_id")


# --- encoding and new features ----------------------------------------------------------


@query("b38_one_hot_encoding", """select event_id, """ + ", ".join(
    f"cast(event_type = '{v}' as integer) as event_type_{v}" for v in ("click", "error", "purchase", "signup", "view")) + " from events")
def b38(spark, sf_dir):
    return encode.one_hot_encoding(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type")


@query("b39_ordinal_encoding", "select p_partkey, p_type, dense_rank() over (order by p_type) - 1 as p_type_code from part")
def b39(spark, sf_dir):
    return encode.ordinal_encoding(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type")


@query("b40_frequency_encoding", """with c as (select p_name, count(*) as n from part group by 1)
 select p_partkey, p_name, case when n >= 80 then n else 0 end as p_name_freq from part join c using (p_name)""")
def b40(spark, sf_dir):
    return encode.frequency_encoding(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", min_freq=80)


@query("b41_target_encoding", f"""with t as (select o_orderkey as id, o_custkey, cast(o_orderstatus = 'F' as integer) as y from orders),
 tr as (select * from t where not {TEST}), m as (select o_custkey, avg(y) as mean from tr group by 1)
 select id, t.o_custkey, y, round(coalesce(mean, (select avg(y) from tr)), 6) as o_custkey_target from t left join m on t.o_custkey = m.o_custkey""")
def b41(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    train, _ = split.split_holdout(rows, None, split.BY_THRESHOLD)
    return rounded(encode.target_encoding(rows, "o_custkey", "y", train), "o_custkey_target", digits=6)


@query("b42_ratios", "select l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_extendedprice / l_quantity as l_extendedprice_per_l_quantity, case when l_discount <> 0 then l_quantity / l_discount end as l_quantity_per_l_discount from lineitem")
def b42(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount")
    return engineer.ratios(lines, [("l_extendedprice", "l_quantity"), ("l_quantity", "l_discount")])


@query("b43_aggregations", """select l_partkey, l_quantity, round(l_extendedprice, 2) as l_extendedprice, round(avg(l_extendedprice) over w, 7) as l_extendedprice_mean_by_l_partkey,
 max(l_extendedprice) over w as l_extendedprice_max_by_l_partkey, sum(l_quantity) over w as l_quantity_sum_by_l_partkey from lineitem window w as (partition by l_partkey)""")
def b43(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    out = engineer.aggregations(lines, ["l_partkey"], {"l_extendedprice": ["mean", "max"], "l_quantity": ["sum"]})
    return rounded(out, "l_extendedprice_mean_by_l_partkey", digits=7).withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@query("b44_interactions", f"select id, qty, price, n_lines, qty * price as qty_x_price, qty * n_lines as qty_x_n_lines, price * n_lines as price_x_n_lines from {X_SQL}")
def b44(spark, sf_dir):
    return engineer.interactions(features_x(spark, sf_dir).select("id", "qty", "price", "n_lines"), ["qty", "price", "n_lines"])


@query("b45_polynomial_features", f"select id, qty, disc, qty * qty as qty_pow2, qty * disc as qty_disc, disc * disc as disc_pow2 from {X_SQL}")
def b45(spark, sf_dir):
    return engineer.polynomial_features(features_x(spark, sf_dir).select("id", "qty", "disc"), ["qty", "disc"], 2)
