import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.functions.columns import missing_to_null, numeric_cols
from sensorlens.operators import profile as P


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_numeric_cols_skip_booleans_and_excluded(frame):
    df = frame("id long, a double, b boolean, c decimal(5,2), d string", (1, 1.0, True, None, "x"))
    assert numeric_cols(df, ["id"]) == ["a", "c"]
    assert numeric_cols(df.select()) == []


def test_quartet_moments(numbers):
    r = P.column_stats(numbers(1, 2, 3, 4)).first()
    assert (r["n"], r["missing"], r["min"], r["max"], r["mean"]) == (4, 0, 1.0, 4.0, 2.5)
    assert r["std"] == pytest.approx(1.290994, abs=1e-6)


def test_missing_values_are_null_and_nan(frame):
    df = missing_to_null(frame("x double", (1.0,), (None,), (math.nan,), (3.0,)))
    stats = P.column_stats(df).first()
    assert (stats["missing"], stats["missing_ratio"], stats["mean"]) == (2, 0.5, 2.0)
    assert P.cardinality_count(df).first()["unique"] == 3


def test_empty_frame_reports_without_error(numbers):
    df = numbers()
    r = P.column_stats(df).first()
    assert (r["n"], r["missing"], r["missing_ratio"], r["mean"]) == (0, 0, None, None)
    assert P.null_count(df).first()["missing_ratio"] is None
    assert P.describe(df).first()["count"] == 0
    assert P.histograms(df).count() == 0
    assert P.boxplots(df).count() == 0
    assert P.cardinality_count(df).first()["unique"] == 0


def test_describe_without_numeric_columns_is_empty(frame):
    assert P.describe(frame("a string", ("x",)), numeric_only=True).count() == 0


def test_describe_text_mode_breaks_ties_by_smallest(frame):
    r = P.describe(frame("a string", ("b",), ("a",), ("b",), ("a",), (None,), ("c",))).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_percentile_names(numbers):
    t = P.percentile_analysis(numbers(*range(101)), (0.01, 0.05, 0.95, 0.99, 0.999))
    assert t.columns == ["column", "ordinal", "p1", "p5", "p95", "p99", "p99.9"]
    assert t.first()["p5"] == 5.0
    approx = P.percentile_analysis(numbers(*range(101)), (0.5,), exact=False)
    assert approx.first()["p50"] == 50.0


def test_histogram_edges(numbers):
    rows = P.histograms(numbers(*range(11)), bins=5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 2, 2, 2, 3]
    assert (rows[0]["lower"], rows[-1]["upper"]) == (0.0, 10.0)


def test_histogram_leaves_missing_out_and_agrees_with_numpy(numbers):
    values = [0.5, 1.5, 1.6, 9.9, None, None, 4.0]
    rows = P.histograms(numbers(*values), bins=4).orderBy("bin").collect()
    counts, _ = np.histogram([v for v in values if v is not None], bins=4)
    assert [r["n"] for r in rows] == counts.tolist()


def test_histogram_of_constant(numbers):
    rows = P.histograms(numbers(5, 5, 5, 5), bins=3).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 4, 0]
    assert (rows[0]["lower"], rows[2]["upper"]) == (4.5, 5.5)


def test_cardinality_batches_agree(frame, monkeypatch):
    df = frame("a int, b int, c int", (1, 1, None), (2, 1, None), (None, 1, None))
    whole = [tuple(r) for r in P.cardinality_count(df).collect()]
    monkeypatch.setattr(P, "DISTINCT_COLUMNS_PER_SCAN", 1)
    assert [tuple(r) for r in P.cardinality_count(df).collect()] == whole
    assert whole == [("a", 0, 3), ("b", 1, 1), ("c", 2, 1)]
    assert P.cardinality_count(df, 1).count() == 1
    assert P.cardinality_count(df, approx=True).first()["unique"] == 3


def test_label_distribution_lists_missing_last(frame):
    rows = P.label_distribution(frame("y int", (1,), (None,), (0,), (1,)), "y").collect()
    assert [tuple(r) for r in rows] == [(0, 1), (1, 2), (None, 1)]


def test_row_cap_marks_longer_reports(spark):
    report = spark.range(5).withColumnRenamed("id", "ordinal")
    cut = P.row_cap(report, 3, ["ordinal"]).collect()
    assert [(r.ordinal, r.truncated) for r in cut] == [(0, True), (1, True), (2, True)]
    assert not P.row_cap(report, 5, ["ordinal"]).first()["truncated"]


def test_features_as_rows_handles_a_feature_named_like_a_statistic(frame):
    t = frame("statistic string, mean double, x double", ("count", 3.0, 4.0), ("max", 7.0, 8.0))
    rows = {r["NameColumn"]: (r["count"], r["max"]) for r in P.features_as_rows(t, "statistic").collect()}
    assert rows == {"mean": (3.0, 7.0), "x": (4.0, 8.0)}


def test_outliers(numbers):
    df = numbers(*([1, 2, 3, 4] * 5), 100, None)
    iqr = P.outlier_detection(df).first()
    assert (iqr["outliers"], iqr["n"]) == (1, 21)
    assert P.outlier_detection(df, "zscore").first()["outliers"] == 1
    with pytest.raises(ValueError):
        P.outlier_detection(df, "other")
    assert P.outlier_detection(numbers(5, 5), "zscore").first()["outliers"] == 0


def test_boxplot_whiskers_stay_within_fences(numbers):
    r = P.boxplots(numbers(1, 2, 3, 4, 100)).first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (1.0, 4.0, 1)


def test_duplicates_and_rules(frame):
    df = frame("a int, b int", (1, 1), (1, 1), (1, None), (1, None), (2, 5))
    r = P.duplicate_detection(df).first()
    assert (r["n_rows"], r["n_distinct"], r["n_duplicates"]) == (5, 3, 2)
    assert P.range_validation(df, [("b", 2, None)]).first()["below"] == 2
    checks = P.inconsistency_checks(df, {"b>1": "b > 1"}).first()
    assert (checks["violations"], checks["undecided"]) == (2, 2)


@pytest.mark.parametrize("bound", [2, 10_000])
def test_spearman_with_ties(spark, bound, monkeypatch):
    from sensorlens.operators import ranks

    monkeypatch.setattr(ranks, "LOOKUP_BOUND", bound)
    rows = [(1.0, 10.0), (2.0, 9.0), (2.0, 7.0), (3.0, 7.0), (4.0, 1.0), (4.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")

    def rank(v):
        order = sorted(v)
        return [np.mean([i + 1 for i, o in enumerate(order) if o == x]) for x in v]

    expected = np.corrcoef(rank([a for a, _ in rows]), rank([b for _, b in rows]))[0, 1]
    got = P.correlation_matrix(df, "spearman").first()["corr"]
    assert got == pytest.approx(expected)


def test_pca_agrees_with_numpy(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0.3, 0.1]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "id int, a double, b double, c double")
    got = P.pca_exploratory(df, 2, keep=["id"]).orderBy("id").toPandas()[["pc1", "pc2"]].to_numpy()
    z = (data - data.mean(0)) / data.std(0)
    _, _, vt = np.linalg.svd(z - z.mean(0))
    assert np.abs(got) == pytest.approx(np.abs(z @ vt[:2].T), abs=1e-8)


def test_scatter_sample_is_repeatable(spark):
    df = spark.range(200).withColumn("x", F.col("id") * 1.0)
    one = {r.id for r in P.scatter_matrix(df, 50).collect()}
    two = {r.id for r in P.scatter_matrix(df.repartition(5), 50).collect()}
    assert one == two and len(one) == 50


def test_split_sizes(spark):
    rows = P.split_sizes({"train": spark.range(7), "test": spark.range(1)}).orderBy("ordinal").collect()
    assert [(r.split, r.n_rows, r.percentage) for r in rows] == [("train", 7, 87.5), ("test", 1, 12.5)]


def test_percentile_names_hold_all_digits():
    names = [P.percentile_name(p) for p in (0.05, 0.5, 0.999, 0.9995, 0.0005, 0.001, 0.07, 1.0, 0)]
    assert names == ["p5", "p50", "p99.9", "p99.95", "p0.05", "p0.1", "p7", "p100", "p0"]
