import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.operators import clean, encode, engineer, prep


def values(df, column="x"):
    return [r[column] for r in df.collect()]


def test_median_is_interpolated_and_std_is_population(numbers):
    pre = prep.fit_numeric_preprocessor(numbers(1, 2, 3, 4), ["x"])
    assert pre.fill == {"x": 2.5} and pre.centre == {"x": 2.5}
    assert pre.divisor["x"] == pytest.approx(1.118034, abs=1e-6)


def test_constant_column_scales_to_zero(numbers):
    df = numbers(5, 5, 5, 5)
    assert values(prep.fit_numeric_preprocessor(df, ["x"]).transform(df)) == [0.0] * 4
    assert values(prep.scale_columns(df, ["x"], "minmax")) == [0.0] * 4


def test_column_without_values_is_refused(numbers):
    with pytest.raises(ValueError, match="cannot be imputed"):
        prep.fit_numeric_preprocessor(numbers(None, None), ["x"])


@pytest.mark.parametrize("cfg", [{"numeric_imputer": "knn"}, {"scaling": "log"}])
def test_unknown_settings_are_refused(numbers, cfg):
    with pytest.raises(ValueError):
        prep.fit_numeric_preprocessor(numbers(1), ["x"], prep.PreprocessConfig(**cfg))


@pytest.mark.parametrize("scaling", prep.SCALERS)
def test_ml_stages_equal_the_projection(frame, scaling):
    df = frame("a double, b int, c int", (1.0, 4, 0), (None, 8, 1), (4.0, None, 1), (7.5, 2, 0))
    cfg = prep.PreprocessConfig("mean", scaling, (1.0, 3.0) if scaling == "minmax" else (0.0, 1.0))
    pre = prep.fit_numeric_preprocessor(df, ["b", "a"], cfg)
    assert pre.transform(df, ["c"]).columns == ["c", "b", "a"]
    plain = [[r.b, r.a] for r in pre.transform(df).collect()]
    vectors = [r.features.toArray().tolist() for r in pre.assemble(df).collect()]
    assert np.array(vectors) == pytest.approx(np.array(plain))
    if scaling == "minmax":
        assert (min(v[0] for v in plain), max(v[0] for v in plain)) == pytest.approx((1.0, 3.0))


def test_parameters_come_from_training_rows(numbers):
    train, other = numbers(0, 10), numbers(None, 20)
    assert values(prep.impute_columns(other, ["x"], "mean", train)) == [5.0, 20.0]
    assert values(prep.scale_columns(other, ["x"], "maxabs", train)) == [None, 2.0]


def test_casting_and_formats(frame):
    df = frame("a string, b double", ("1", 0.0), ("x", 2.0))
    assert values(prep.type_casting(df, {"a": "int"}), "a") == [1, None]
    sparse = prep.sparse_dense_format(df, ["b"], "sparse")
    assert [len(r.entries) for r in sparse.collect()] == [0, 1]
    with pytest.raises(ValueError):
        prep.sparse_dense_format(df, ["b"], "csr")


def test_dropping(frame):
    df = frame("a int, b int, c int", (1, None, None), (1, 2, None), (1, 2, 3))
    assert clean.drop_rows(df).count() == 1
    assert clean.drop_columns(df, 0.5).columns == ["a", "b"]
    assert clean.drop_rows_threshold(df, 0.5).count() == 2


def test_clipping_keeps_missing(numbers):
    df = numbers(1, 2, 3, 4, 1000, None)
    assert values(clean.iqr_clipping(df, ["x"]))[4:] == [7.0, None]
    assert values(clean.winsorization(df, ["x"], (0.25, 0.25))) == [2.0, 2.0, 3.0, 4.0, 4.0, None]
    assert clean.zscore_filtering(df, ["x"], 1.5).count() == 5


def test_log_and_power(numbers):
    assert values(clean.log_transform(numbers(-3, 0), ["x"])) == pytest.approx([0.0, math.log(4)])
    rng = np.random.default_rng(1)
    skewed = numbers(*np.exp(rng.normal(size=400)))
    assert abs(clean.fit_power(skewed, ["x"], "box_cox")["x"]) <= 0.1
    with pytest.raises(ValueError, match="positive"):
        clean.fit_power(numbers(0, 1), ["x"], "box_cox")
    plain = numbers(*rng.normal(size=400))
    assert 0.7 <= clean.fit_power(plain, ["x"], "yeo_johnson")["x"] <= 1.3
    assert clean.fit_power(numbers(4, 4), ["x"], "box_cox")["x"] == 1.0


def test_iterative_imputation_recovers_a_plane(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        a, b = rng.normal(size=2)
        rows.append((i, float(a), float(b), None if i % 10 == 0 else float(2 * a - b + 1)))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    filled = {r.id: r for r in clean.iterative_imputation(df, ["a", "b", "c"], 2).collect()}
    assert len(filled) == 200
    for i, a, b, c in rows:
        assert filled[i].c == pytest.approx(2 * a - b + 1, abs=1e-3)


def test_text_cleaning(frame):
    df = frame("t string", ("  Été--N°1 ",), (None,), ("ÇA VA",))
    assert values(clean.fix_typos(df, ["t"]), "t") == ["été n 1", None, "ça va"]
    assert values(clean.text_normalization(df, ["t"]), "t") == ["ete--n°1", None, "ca va"]


def test_duplicates_keep_first(frame):
    df = frame("k int, at int, v string", (1, 2, "b"), (1, 1, "a"), (2, 5, None), (2, 5, None))
    assert clean.exact_duplicates(df).count() == 3
    kept = sorted(map(tuple, clean.exact_duplicates(df, ["k"], "at").collect()))
    assert kept == [(1, 1, "a"), (2, 5, None)]


def test_mode_and_constant(frame):
    df = frame("a string", ("b",), ("a",), (None,))
    assert values(encode.mode_imputation(df, ["a"]), "a") == ["b", "a", "a"]
    assert values(encode.constant_imputation(df, ["a"]), "a")[-1] == "missing"
    assert encode.mode_value(frame("a string", (None,)), "a") is None


@pytest.mark.parametrize("bound", [1, 10_000])
def test_encodings(frame, bound):
    train = frame("c string, y int", ("b", 1), ("a", 0), ("b", 0), ("c", 1), (None, 1))
    new = frame("c string", ("b",), ("zzz",), (None,))
    assert values(encode.ordinal_encoding(new, "c", train, bound).orderBy("c_code"), "c_code") == [None, None, 1]
    freq = {r.c: r.c_freq for r in encode.frequency_encoding(new, "c", 2, train, bound).collect()}
    assert freq == {"b": 2, "zzz": 0, None: 0}
    target = {r.c: r.c_target for r in encode.target_encoding(new, "c", "y", train, bound).collect()}
    assert target == {"b": 0.5, "zzz": 0.6, None: 0.6}


def test_one_hot(frame):
    train = frame("c string", ("x y",), ("b",))
    got = encode.one_hot_encoding(frame("c string", ("b",), ("new",), (None,)), "c", train)
    assert got.columns == ["c_b", "c_x_y"]
    assert [tuple(r) for r in got.collect()] == [(1, 0), (0, 0), (0, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        encode.one_hot_encoding(train, "c", at_most=1)
    vector = encode.one_hot_vector(train, "c", "v").transform(train)
    assert all(r.v.toArray().sum() == 1 for r in vector.collect())


def test_rare_grouping(frame):
    df = frame("c string", *[("a",)] * 8, ("b",), ("c",), (None,))
    got = [r.c for r in encode.rare_grouping(df, "c", 0.2).collect()]
    assert got == ["a"] * 8 + ["Other", "Other", None]


@pytest.mark.parametrize("bound", [1, 10_000])
def test_new_features(frame, bound):
    df = frame("g int, h int, v double", (1, 1, 2.0), (1, 1, 4.0), (2, 1, 6.0), (None, 1, 8.0))
    one = engineer.aggregations(df, ["g"], {"v": ["mean", "count"]}, bound)
    assert sorted((r.v, r.v_mean_by_g) for r in one.collect()) == [(2.0, 3.0), (4.0, 3.0), (6.0, 6.0), (8.0, None)]
    two = engineer.aggregations(df, ["g", "h"], {"v": ["max"]}, bound)
    assert {r.v: r.v_max_by_g_h for r in two.collect()} == {2.0: 4.0, 4.0: 4.0, 6.0: 6.0, 8.0: None}
    assert engineer.ratios(df, [("v", "g")]).first()["v_per_g"] == 2.0
    assert "g_x_h" in engineer.interactions(df, ["g", "h"]).columns
    cubic = engineer.polynomial_features(df, ["v"], 3)
    assert cubic.first()["v_pow3"] == 8.0
