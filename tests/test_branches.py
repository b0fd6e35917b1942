"""Deep trees in tables against the trees that Spark ML grows on the driver."""

import numpy as np
import pytest

from sensorlens.operators import branches, model, prep

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    made = rng.integers(0, 9, (2_000, 3))
    noise = rng.normal(size=2_000)
    data = [
        (i, *map(float, x), float((x[0] > 2) != (x[1] > 3) if u < 0.7 else u < 0.85), float(x[0] * x[1] - 3 * x[2] + e))
        for i, (x, u, e) in enumerate(zip(made, rng.random(2_000), noise))
    ]
    return spark.createDataFrame(data, "id long, a double, b double, c double, kind double, y double").repartition(3).cache()


@pytest.fixture()
def small_branches(monkeypatch):
    monkeypatch.setattr(branches, "LEAST_CELLS", 0)
    monkeypatch.setattr(branches, "BRANCH", 150)
    monkeypatch.setattr(branches, "LEAST_BRANCH", 150)


@pytest.mark.parametrize("name, registry, label, params", [
    ("decision_tree_classifier", model.CLASSIFIERS, "kind", {"max_depth": None}),
    ("decision_tree_classifier", model.CLASSIFIERS, "kind", {"max_depth": 12, "min_samples_leaf": 9, "criterion": "entropy"}),
    ("decision_tree_regressor", model.REGRESSORS, "y", {"max_depth": None, "min_samples_leaf": 3}),
])
def test_branches_give_the_trees_of_spark(rows, small_branches, name, registry, label, params):
    pre = prep.fit_numeric_preprocessor(rows, FEATURES)
    est = model.build_estimators({name: params}, registry)[name]
    fitted = model.fit_models(pre, {name: est}, rows, label)[name]
    tree = fitted.stages[-1]
    assert isinstance(tree, branches.BranchTree) and len(tree.grown.roots) > 2
    plain = est.fit(model.labelled(pre, rows, label))
    assert len(tree.grown.top.value) < 30  # what the driver holds of a tree of hundreds of nodes
    got = {r["id"]: r["prediction"] for r in model.predict(fitted, rows, ["id"]).collect()}
    want = {r["id"]: r["prediction"] for r in plain.transform(model.labelled(pre, rows, label, ["id"])).collect()}
    assert len(got) == 2_000 and max(abs(got[i] - want[i]) for i in want) < 1e-9
    assert np.allclose(tree.featureImportances.toArray(), plain.featureImportances.toArray())


def test_depths_share_one_tree(rows, small_branches, monkeypatch):
    grown, init = [], branches.Grown.__init__
    monkeypatch.setattr(branches.Grown, "__init__", lambda self, *a: (grown.append(a[2].getMaxDepth()), init(self, *a))[1])
    pre = prep.fit_numeric_preprocessor(rows, FEATURES)
    made = {f"decision_tree_classifier#{d}": model.build_estimators({"decision_tree_classifier": {"max_depth": d}})["decision_tree_classifier"] for d in (2, 6, None)}
    fitted = model.fit_models(pre, made, rows, "kind")
    assert grown == [30] and list(fitted) == list(made)
    scored = model.score_models(fitted, rows, "kind").groupBy("model", "label", "prediction").count().collect()
    for name, est in made.items():
        plain = est.fit(model.labelled(pre, rows, "kind"))
        want = plain.transform(model.labelled(pre, rows, "kind")).groupBy("label", "prediction").count().collect()
        assert {(r["label"], r["prediction"], r["count"]) for r in scored if r["model"] == name} == {tuple(r) for r in want}
        assert np.allclose(fitted[name].stages[-1].featureImportances.toArray(), plain.featureImportances.toArray())


def test_a_search_scores_trees_in_tables_as_spark_does(rows, monkeypatch):
    tried = [("decision_tree_classifier", {"max_depth": d, "min_samples_leaf": n}) for d in (3, None) for n in (1, 10)]
    columns = ["candidate", "fold", "accuracy", "f1_weighted", "support"]

    def found():
        report = model.search_pipeline(rows, FEATURES, "kind", tried, folds=2)
        return sorted(map(tuple, report.select(columns).collect()))

    want = found()
    monkeypatch.setattr(branches, "LEAST_CELLS", 0)
    monkeypatch.setattr(branches, "BRANCH", 300)
    monkeypatch.setattr(branches, "LEAST_BRANCH", 300)
    assert np.allclose(found(), want)


def test_one_branch_and_one_class(spark, small_branches):
    rows = spark.createDataFrame([(i, float(i % 4), 1.0) for i in range(40)], "id long, a double, kind double")
    fitted = model.fit_models(prep.fit_numeric_preprocessor(rows, ["a"]), model.build_estimators({"decision_tree_classifier": {}}), rows, "kind")
    assert {r["prediction"] for r in model.predict(fitted["decision_tree_classifier"], rows, ["id"]).collect()} == {1.0}
