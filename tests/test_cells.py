"""Trees on weighted cells against the same trees on rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from sensorlens.operators import cells, model, prep


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    made = rng.integers(0, 6, (3_000, 3))
    noise = rng.normal(size=3_000)
    data = [
        (i, *map(float, x), float((x[0] > 2) != (x[1] > 3) if u < 0.8 else u < 0.9), float(x[0] * x[1] - 3 * x[2] + e))
        for i, (x, u, e) in enumerate(zip(made, rng.random(3_000), noise))
    ]
    return spark.createDataFrame(data, "id long, a double, b double, c double, kind double, y double").repartition(3).cache()


@pytest.mark.parametrize("name, registry, label, params", [
    ("decision_tree_classifier", model.CLASSIFIERS, "kind", {"max_depth": 4}),
    ("decision_tree_classifier", model.CLASSIFIERS, "kind", {"max_depth": 5, "min_samples_leaf": 40}),
    ("decision_tree_regressor", model.REGRESSORS, "y", {"max_depth": 5, "min_samples_leaf": 7}),
    ("boosted_trees_regressor", model.REGRESSORS, "y", {"n_estimators": 6, "max_depth": 3}),
])
def test_cells_give_the_trees_of_the_rows(rows, tmp_path, name, registry, label, params):
    pre = prep.fit_numeric_preprocessor(rows, ["a", "b", "c"])
    est = model.build_estimators({name: params}, registry)[name]
    fitted = model.fit_models(pre, {name: est}, rows, label)[name]
    plain = est.fit(model.labelled(pre, rows, label))
    got = {r["id"]: r["prediction"] for r in model.predict(fitted, rows, ["id"]).collect()}
    want = {r["id"]: r["prediction"] for r in plain.transform(model.labelled(pre, rows, label, ["id"])).collect()}
    assert len(got) == 3_000 and max(abs(got[i] - want[i]) for i in want) < 1e-6
    assert np.allclose(fitted.stages[-1].featureImportances.toArray(), plain.featureImportances.toArray())
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert {r["id"]: r["prediction"] for r in model.predict(again, rows, ["id"]).collect()} == got


def test_cells_are_as_many_as_combinations_of_bins(rows):
    vectors = model.labelled(prep.fit_numeric_preprocessor(rows, ["a", "b", "c"]), rows, "kind")
    held = cells.Cells(vectors, 32, True)
    assert held.rows == 3_000 and held.table.count() <= 6**3 * 2
    one = model.build_estimators({"decision_tree_classifier": {"min_samples_leaf": 1_600}})["decision_tree_classifier"]
    assert held.fit(one) is None  # such leaves are left to the rows
    forest = model.build_estimators({"random_forest_classifier": {}})["random_forest_classifier"]
    assert not cells.suits(forest)


def test_a_value_lies_in_the_bin_that_ends_with_it(spark):
    df = spark.createDataFrame([(Vectors.dense(v, 7.0),) for v in (-1.0, 1.0, 1.5, 2.0, 9.0)], ["features"])
    stage = cells.Bins([[1.0, 2.0], []])
    assert [r["_bins"].toArray()[0] for r in stage.transform(df).collect()] == [0.0, 0.0, 1.0, 1.0, 2.0]
    many = spark.range(1_000).selectExpr("array(cast(id as double), 4.0D) as v").select(cells.F.col("v"))
    vectors = many.select(cells.F.expr("v")).rdd.map(lambda r: (Vectors.dense(r["v"]),)).toDF(["features"])
    cuts = cells.bin_cuts(vectors, 10)
    assert len(cuts[0]) == 9 and abs(cuts[0][4] - 499.5) <= 1 and cuts[1] == []


def test_fits_side_by_side_take_fewer_tasks_each(rows, monkeypatch):
    monkeypatch.setattr(cells, "CELLS_A_TASK", 40)
    vectors = model.labelled(prep.fit_numeric_preprocessor(rows, ["a", "b", "c"]), rows, "kind")
    alone, shared = cells.Cells(vectors, 32, True), cells.Cells(vectors, 32, True, 4)
    assert shared.table.rdd.getNumPartitions() < alone.table.rdd.getNumPartitions()
    assert shared.rows == alone.rows == 3_000 and shared.table.count() == alone.table.count()


def test_the_deepest_fit_begins_first(rows, monkeypatch):
    begun, fit = [], cells.Cells.fit
    monkeypatch.setattr(model, "FITS_AT_ONCE", 1)
    monkeypatch.setattr(cells.Cells, "fit", lambda self, est: (begun.append(est.getMaxDepth()), fit(self, est))[1])
    made = {f"decision_tree_classifier#{d}": model.build_estimators({"decision_tree_classifier": {"max_depth": d}})["decision_tree_classifier"] for d in (1, 4, 2)}
    fitted = model.fit_models(prep.fit_numeric_preprocessor(rows, ["a", "b", "c"]), made, rows, "kind")
    assert begun == [4, 2, 1] and list(fitted) == list(made)
    assert [m.stages[-1].getMaxDepth() for m in fitted.values()] == [1, 4, 2]  # leaves that agree are merged, so depths may be less
