"""How the roles of the operators are played by the star-schema test tables.

Each role has a Spark form and a SQL twin, so that both sides of a check start from the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted
from sensorlens.sources.reader import read_table

FEATURES = ["qty", "price", "disc", "tax", "n_lines"]
WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey"]
LABEL = "faulty"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def features_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table: order lines summed per order."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_quantity").alias("qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.avg("l_discount"), 6).alias("disc"),
        F.round(F.avg("l_tax"), 6).alias("tax"),
        F.count("*").alias("n_lines"),
    )


X_SQL = """(select l_orderkey as id, sum(l_quantity) as qty, round(sum(l_extendedprice), 2) as price,
 round(avg(l_discount), 6) as disc, round(avg(l_tax), 6) as tax, count(*) as n_lines
 from lineitem group by l_orderkey)"""


def labels_y(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label table: one row per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("faulty"),
        F.col("o_totalprice").alias("margin"),
    )


Y_SQL = """(select o_orderkey as id, cast(o_orderstatus = 'F' as integer) as faulty,
 o_totalprice as margin from orders)"""


def joined_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_x(spark, sf_dir).join(labels_y(spark, sf_dir), "id")


XY_SQL = f"(select x.*, y.faulty, y.margin from {X_SQL} x join {Y_SQL} y on x.id = y.id)"


def wide_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a wide numeric table; quantity 17 and tax 0.03 count as missing."""
    lines = table(spark, sf_dir, "lineitem").select(*[quoted(c) for c in WIDE])
    return lines.withColumns(
        {
            "l_quantity": F.nullif("l_quantity", F.lit(17.0)),
            "l_tax": F.nullif("l_tax", F.lit(0.03)),
        }
    )


WIDE_SQL = """(select nullif(l_quantity, 17) as l_quantity, l_extendedprice, l_discount,
 nullif(l_tax, 0.03::double) as l_tax, l_partkey, l_suppkey from lineitem)"""


def x_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with gaps, for imputation by row."""
    return features_x(spark, sf_dir).withColumns(
        {
            "qty": F.when(F.col("qty") % 7 != 0, F.col("qty")),
            "disc": F.when(F.col("n_lines") != 3, F.col("disc")),
        }
    )


X_MISSING_SQL = f"""(select id, case when cast(qty as bigint) % 7 <> 0 then qty end as qty, price,
 case when n_lines <> 3 then disc end as disc, tax, n_lines from {X_SQL})"""


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined rows with a rule in place of a model, so that scores have a SQL twin."""
    return joined_xy(spark, sf_dir).select(
        "id",
        F.col("faulty").alias("label"),
        (F.col("price") > 150000).cast("int").alias("prediction"),
        (F.col("margin") > 200000).cast("int").alias("prediction_b"),
    )


SCORED_SQL = f"""(select id, faulty as label, cast(price > 150000 as integer) as prediction,
 cast(margin > 200000 as integer) as prediction_b from {XY_SQL})"""


def digest_sql(key: str, seed: int = 42, digits: int = 8) -> str:
    return f"substr(md5(cast({key} as varchar) || ':{seed}'), 1, {digits})"
