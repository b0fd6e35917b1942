"""Search over folds: sums against models that are fitted again on every training part."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from sensorlens.operators import bayes, fold_sums, model, prep


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        a, b = rng.normal(1e4, 30), rng.normal(-3, 0.5)
        y = 2 * a - 500 * b + rng.normal(0, 20)
        kind = int(a > 1e4) if rng.random() < 0.9 else 2
        rows.append((i, None if i % 7 == 0 else a, None if i % 11 == 0 else b, 5.0, None if i % 50 == 0 else y, kind))
    return spark.createDataFrame(rows, "id long, a double, b double, k double, y double, kind int").persist()


@pytest.mark.parametrize("imputer, scaling", [("mean", "standard"), ("median", "standard"), ("mean", "none")])
def test_sums_give_what_fitting_again_gives(gappy, imputer, scaling):
    cfg = prep.PreprocessConfig(imputer, scaling)
    alphas = {"linear_regression": [0], "ridge_regression": [30.0], "lasso_regression": [2.0]}
    found = fold_sums.linear_search(gappy, ["a", "b", "k"], "y", alphas, folds=3, cfg=cfg)
    tried = [(n, {"alpha": a[0]} if a[0] else {}) for n, a in alphas.items()]
    again = model.search_pipeline(gappy, ["a", "b", "k"], "y", tried, model.REGRESSORS, folds=3, cfg=cfg)
    want = {(r["candidate"], r["fold"]): (r["rmse"], r["support"]) for r in again.collect()}
    got = {(r["candidate"], r["fold"]): (r["rmse"], r["support"]) for r in found.collect()}
    assert got.keys() == want.keys() and len(got) == 9
    for k in want:
        assert got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0], rel=2e-3 if scaling == "none" else 1e-5)
    assert sum(n for _, n in got.values()) == 3 * (900 - 18)


def test_best_candidate_and_choice(gappy):
    found = fold_sums.linear_search(gappy, ["a", "b"], "y", {"ridge_regression": [1e6, 1.0, 1.0]}, folds=3)
    assert fold_sums.best_candidate(found)["candidate"] == 1
    drawn = fold_sums.linear_search(gappy, ["a"], "y", {"lasso_regression": [1.0 * i for i in range(50)]}, "random", 30, folds=2)
    assert drawn.select("candidate").distinct().count() == 30 == drawn.select("alpha").distinct().count()


def test_smoothing_search_gives_what_fitting_again_gives(gappy):
    for scaling in ("none", "standard"):
        cfg = prep.PreprocessConfig("mean", scaling)
        smoothings = [1e-9, 0.5]
        found = bayes.bayes_search(gappy, ["a", "b", "k"], "kind", smoothings, folds=3, cfg=cfg)
        tried = [("naive_bayes_classifier", {"var_smoothing": s}) for s in smoothings]
        again = model.search_pipeline(gappy, ["a", "b", "k"], "kind", tried, folds=3, cfg=cfg)
        pick = lambda df: sorted((r["candidate"], r["fold"], round(r["accuracy"], 9), round(r["f1_weighted"], 9)) for r in df.collect())
        assert pick(found) == pick(again)


def test_a_smoothed_model_is_saved_with_its_pipeline(gappy, tmp_path):
    pre = prep.fit_numeric_preprocessor(gappy, ["a", "b"])
    made = model.build_estimators({"naive_bayes_classifier": {"var_smoothing": 0.1}})
    fitted = model.fit_models(pre, made, gappy, "kind")["naive_bayes_classifier"]
    fitted.write().overwrite().save(str(tmp_path / "bayes"))
    again = PipelineModel.load(str(tmp_path / "bayes"))
    pick = lambda m: [tuple(r) for r in model.predict(m, gappy, ["id"]).orderBy("id").collect()]
    assert pick(again) == pick(fitted)


def test_what_sums_cannot_do_is_refused(gappy, frame):
    with pytest.raises(ValueError):
        fold_sums.linear_search(gappy, ["a"], "y", {"ridge_regression": [1.0]}, cfg=prep.PreprocessConfig(scaling="robust"))
    with pytest.raises(ValueError):
        fold_sums.linear_search(gappy, ["a"], "y", {"svm_classifier": [1.0]})
    with pytest.raises(ValueError):
        fold_sums.linear_search(gappy, ["a"], "y", {"ridge_regression": [1.0]}, strategy="guess")
    with pytest.raises(ValueError):
        fold_sums.linear_search(frame("id long, a double, y double", (1, None, 1.0), (2, 1.0, 2.0)), ["a"], "y", {"ridge_regression": [1.0]}, folds=2)
    with pytest.raises(ValueError):
        model.build_estimators({"decision_tree_classifier": {"min_samples_split": 10}})


def test_share_of_columns(spark):
    made = lambda p: model.build_estimators({"boosted_trees_regressor": p}, model.REGRESSORS)["boosted_trees_regressor"]
    assert [made({"colsample_bytree": s}).getFeatureSubsetStrategy() for s in (1, 1.0, 0.8)] == ["all", "all", "0.8"]
    assert made({}).getFeatureSubsetStrategy() == "all"
    with pytest.raises(ValueError):
        made({"colsample_bytree": 0})
