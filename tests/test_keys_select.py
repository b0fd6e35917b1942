import pytest
from pyspark.sql import functions as F

from sensorlens.operators import integrate, keys, select


@pytest.fixture()
def dup(frame):
    x = frame("id int, a string", (1, "p"), (1, "q"), (2, "r"))
    y = frame("id int, b string", (1, "s"), (1, "t"), (3, "u"))
    return x, y


def test_repeated_keys_fan_out(dup):
    x, y = dup
    assert keys.inner_join_x_y(x, y, "id").count() == 4
    with pytest.raises(ValueError, match="repeats in X"):
        keys.one_to_one_join(x, y, "id")
    for side in dup:
        assert keys.duplicate_key_count(side, "id").first()["duplicate_rows"] == 1
    facts = keys.key_overlap(x, y, "id").first().asDict()
    assert (facts["keys_only_x"], facts["keys_only_y"], facts["keys_matched"]) == (1, 1, 1)
    assert keys.row_parity(x, y, "id").first()["same_rows"]


def test_missing_keys(frame):
    x, y = frame("id int, a int", (1, 1), (None, 2)), frame("id int, b int", (1, 3), (None, 4))
    assert keys.inner_join_x_y(x, y, "id").count() == 1
    joined = keys.inner_join_x_y(x, y, "id", null_safe=True)
    assert joined.columns == ["id", "a", "b"] and joined.count() == 2


@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_give_the_same_rows(spark, null_safe):
    x = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    y = spark.range(900).select(F.pmod("id", F.lit(450)).alias("k"), F.col("id").alias("b"))
    assert keys.hot_keys(x, "k", 0.05) == [7]
    plain = keys.inner_join_x_y(x, y, "k", null_safe)
    split = keys.inner_join_x_y(x, y, "k", null_safe, hot_share=0.05, salts=4)
    assert split.columns == plain.columns
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


def test_clashing_columns_and_absent_keys(frame):
    x, y = frame("id int, v int", (1, 2)), frame("id int, v int", (1, 3))
    assert keys.inner_join_x_y(x, y, "id").columns == ["id", "v_x", "v_y"]
    with pytest.raises(KeyError):
        keys.inner_join_x_y(x, y.drop("id"), "id")


def test_column_legend(frame):
    rows = keys.column_legend(frame("a int, b int", (1, None)), {"a": {"en": "first"}}).collect()
    assert [(r["column"], r["en"], r["n"]) for r in rows] == [("a", "first", 1), ("b", "(missing description)", 0)]


@pytest.mark.parametrize(
    "values, threshold, removed",
    [
        ((5.0, 5.0, 5.0, 5.0), 1, True),
        ((5.0, 5.0, 5.0, 6.0), 1, False),
        ((5.0, 5.0, 5.0, 6.0), 2, True),
        ((5.0, 5.0, None), 1, False),
        ((5.0, 5.0, None), 2, True),
        ((None, None, None), 1, True),
    ],
)
def test_constant_features(numbers, values, threshold, removed):
    got = select.remove_constant_features(numbers(*values), threshold_unique=threshold)
    assert got.removed == (["x"] if removed else [])


def test_near_constant_features_of_many_values(spark):
    df = spark.range(500).select("id", F.pmod("id", F.lit(3)).alias("three"), F.lit("s").alias("text"))
    assert select.remove_constant_features(df, threshold_unique=2).removed == ["text"]
    assert select.remove_constant_features(df, threshold_unique=3).removed == ["three", "text"]
    assert select.remove_constant_features(df, threshold_unique=100).removed == ["three", "text"]


def test_duplicate_features(frame):
    df = frame("a int, b int, c int", (1, 1, 2), (2, 2, 1), (None, None, None))
    got = select.remove_duplicate_features(df)
    assert got.removed == ["b"] and got.df.columns == ["a", "c"]
    with pytest.raises(ValueError):
        select.remove_duplicate_features(df, strategy="near")


def test_twin_of_a_colliding_column_is_found(frame):
    df = frame("a int, c int, d int, e int", (1, 2, 2, 1), (2, 1, 1, 2))
    assert select.remove_duplicate_features(df).removed == ["d", "e"]


def test_types_keep_columns_apart(frame):
    assert select.remove_duplicate_features(frame("a int, b double", (1, 1.0), (2, 2.0))).removed == []


def test_constant_then_twin(frame):
    df = frame("k int, a int, b int", (7, 1, 1), (7, 2, 2))
    first = select.remove_constant_features(df)
    second = select.remove_duplicate_features(first.df)
    assert (first.removed, second.removed) == (["k"], ["b"])
    again = select.remove_duplicate_features(select.remove_constant_features(second.df).df)
    assert again.removed == []
    kpi = select.before_after_kpi(df, second.df, "both").first()
    assert (kpi.rows_before, kpi.cols_before, kpi.cols_after, kpi.cols_removed) == (2, 3, 1, 2)
    changes = select.before_after_changes(df, second.df.withColumn("n", F.lit(1)), "both").collect()
    assert [(r.change, r["column"]) for r in changes] == [("removed", "b"), ("removed", "k"), ("added", "n")]


def test_missing_label_stops_the_job(frame):
    assert select.cast_label(frame("y double", (1.0,)), "y").first()["y"] == 1
    with pytest.raises(Exception, match="missing value in label"):
        select.cast_label(frame("y double", (None,)), "y").collect()
    with pytest.raises(KeyError):
        select.cast_label(frame("z double", (1.0,)), "y")


def test_column_choices(frame):
    df = frame("row_id int, humidity int, log int, y int", (1, 2, 3, 4))
    assert select.drop_technical_columns(df, ["id", "log"]).columns == ["humidity", "y"]
    assert select.manual_include_exclude(df, exclude=["y"]).columns == ["row_id", "humidity", "log"]
    assert select.semantic_based_selection(df, ["log"], "y", ["row_id"]).columns == ["row_id", "log", "y"]
    assert select.feature_columns(df, "y", ["row_id"]) == ["humidity", "log"]
    x, y = select.x_y_separation(df, "y", ["row_id"])
    assert (x.columns, y.columns) == (["humidity", "log"], ["y"])
    assert select.drop_after_join(df, ["log", "nope"]).columns == ["row_id", "humidity", "y"]
    assert select.rename_columns(df, {"y": "Y"}).columns[-1] == "Y"


def test_integration(frame):
    a = frame("id int, v int, w string", (1, 10, "a"), (2, None, "b"))
    b = frame("id long, v double", (2, 2.5), (3, 3.5))
    ha, hb = integrate.datatype_harmonization([a, b])
    assert dict(ha.dtypes)["v"] == dict(hb.dtypes)["v"] == "double"
    stacked = integrate.union_concat([ha, hb])
    assert stacked.count() == 4 and stacked.filter("w is null").count() == 2
    merged = integrate.priority_rules({"a": ha, "b": hb}, "id", {"v": ["b", "a"]})
    assert sorted((r.id, r.v) for r in merged.collect()) == [(1, 10.0), (2, 2.5), (3, 3.5)]
    keyless = integrate.priority_rules({"a": ha.unionByName(ha.withColumn("id", F.lit(None).cast("long"))), "b": hb}, "id", {})
    assert keyless.count() == 5 and keyless.filter("id is null").count() == 2
    assert integrate.orphan_rows(ha, hb, {"id": "id"}).count() == 1
    assert integrate.dataset_merging(ha, hb, ["id"], "right").count() == 2
    with pytest.raises(ValueError):
        integrate.dataset_merging(ha, hb, ["id"], "cross")
    assert integrate.pk_fk_mapping(ha, hb.withColumnRenamed("id", "key"), {"id": "key"}).count() == 1
    assert integrate.data_enrichment(ha, hb.withColumnRenamed("v", "extra"), "id", ["extra"]).count() == 2


@pytest.mark.parametrize("how", ["inner", "left", "right"])
@pytest.mark.parametrize("many", ["left", "right", "both"])
def test_merging_spreads_hot_keys(spark, how, many):
    def side(name, hot, kind):
        rows = [("hot", 1, i) for i in range(hot)] + [(f"k{i}", i % 3, i) for i in range(40)] + [(None, 1, -1), (name, 2, -2)]
        return spark.createDataFrame(rows, f"k string, g {kind}, {name} long")

    left = side("a", 200 if many != "right" else 3, "int")
    right = side("b", 200 if many != "left" else 3, "long")
    got = integrate.dataset_merging(left, right, ["k", "g"], how, hot_share=0.2, salts=8)
    want = integrate.dataset_merging(left, right, ["k", "g"], how, hot_share=None)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_salt" not in want._jdf.queryExecution().optimizedPlan().toString()
