"""Queries over reading, projecting and casting."""

from __future__ import annotations


from pyspark.sql import functions as F

from sensorlens.functions.columns import select_numeric
from sensorlens.functions.frames import new_folder
from sensorlens.operators.select import (
    cast_label,
    drop_after_join,
    feature_columns,
    rename_columns,
    x_y_separation,
)
from sensorlens.plans.catalog import query
from sensorlens.plans.tables import X_SQL, XY_SQL, Y_SQL, features_x, joined_xy, labels_y, table
from sensorlens.sources.reader import ReadStrategy, parse_number, parse_report, preview, read_csv, read_table

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("a01_scan_full", f"select {', '.join(ORDER_COLUMNS)} from orders")
def a01(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet").select(*ORDER_COLUMNS)


@query("a01_scan_csv", f"select {', '.join(ORDER_COLUMNS)} from orders")
def a01_csv(spark, sf_dir):
    """The orders as delimited text in the shared folder, scanned with a declared schema."""
    path = new_folder(spark, "csv")
    table(spark, sf_dir, "orders").select(*ORDER_COLUMNS).write.option("header", "true").csv(path)
    return read_csv(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")


@query("a02_scan_sample", f"select {', '.join(ORDER_COLUMNS)} from orders order by o_orderkey limit 12000")
def a02(spark, sf_dir):
    first = ReadStrategy(mode="sample", sample_rows=12_000)
    return read_table(spark, f"{sf_dir}/orders.parquet", first, "o_orderkey").select(*ORDER_COLUMNS)


@query("a03_scan_first_chunk", "select event_id, user_id, event_type, value from events order by event_id limit 4000")
def a03(spark, sf_dir):
    chunk = ReadStrategy(mode="chunked", chunk_size=4_000)
    events = read_table(spark, f"{sf_dir}/events.parquet", chunk, "event_id")
    return events.select("event_id", "user_id", "event_type", "value")


def _balances_as_text(spark, sf_dir):
    """Account balances as a delimited file would hold them: comma decimals and blemishes."""
    mark = F.col("c_custkey") % 50
    text = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(mark == 0, F.lit("NA"))
        .when(mark == 1, F.lit(""))
        .when(mark == 2, F.lit("abc"))
        .when(mark == 3, F.lit("NaN"))
        .otherwise(text)
        .alias("balance"),
    )


@query(
    "a04_csv_numbers",
    "select c_custkey as id, case when c_custkey % 50 > 3 then c_acctbal end as balance from customer",
)
def a04(spark, sf_dir):
    raw = _balances_as_text(spark, sf_dir)
    kind = spark.range(0).select(F.lit(1.0).alias("x")).schema["x"].dataType
    return raw.select("id", parse_number(F.col("balance"), kind, ",").alias("balance"))


@query(
    "a04_csv_parse_report",
    """select 'balance' as "column", count(*) as n_rows,
 count(*) filter (c_custkey % 50 in (0, 1, 3)) as missing,
 count(*) filter (c_custkey % 50 > 3) as parsed,
 count(*) filter (c_custkey % 50 = 2) as failed from customer""",
)
def a04_report(spark, sf_dir):
    return parse_report(_balances_as_text(spark, sf_dir), ["balance"], ",")


@query("a06_preview", f"select {', '.join(ORDER_COLUMNS)} from orders order by o_orderkey limit 10")
def a06(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), "o_orderkey")


@query("a11_numeric_cols", "select l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem")
def a11(spark, sf_dir):
    return select_numeric(table(spark, sf_dir, "lineitem"), exclude=["l_orderkey"])


@query("a12_select_numeric", "select o_orderkey, o_custkey, o_totalprice from orders")
def a12(spark, sf_dir):
    return select_numeric(table(spark, sf_dir, "orders"))


@query("a13_drop_after_join", f"select qty, price, disc, tax, n_lines, faulty from {XY_SQL}")
def a13(spark, sf_dir):
    return drop_after_join(joined_xy(spark, sf_dir), ["margin", "id", "not_there"])


@query("a14_feature_projection", f"select qty, price, disc, tax, n_lines from {XY_SQL}")
def a14(spark, sf_dir):
    xy = joined_xy(spark, sf_dir)
    return xy.select(*feature_columns(xy, "faulty", ["id", "margin"]))


@query("a15_x_part", f"select qty, price, disc, tax, n_lines, margin from {XY_SQL}")
def a15_x(spark, sf_dir):
    return x_y_separation(joined_xy(spark, sf_dir), "faulty")[0]


@query("a15_y_part", f"select faulty from {XY_SQL}")
def a15_y(spark, sf_dir):
    return x_y_separation(joined_xy(spark, sf_dir), "faulty")[1]


@query("a16_cast_label", f"select cast(id as integer) as id, cast(faulty as integer) as faulty from {Y_SQL}")
def a16(spark, sf_dir):
    y = labels_y(spark, sf_dir).select("id", F.col("faulty").cast("double").alias("faulty"))
    return cast_label(cast_label(y, "faulty"), "id")


@query("a17_rename_columns", f"select id, qty as QTY, price as PRICE, disc as DISC, tax as TAX, n_lines as N_LINES from {X_SQL}")
def a17(spark, sf_dir):
    x = features_x(spark, sf_dir)
    return rename_columns(x, {c: c.upper() for c in x.columns if c != "id"})
