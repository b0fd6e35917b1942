"""Forests fitted on draws from cells against forests on rows."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from sensorlens.operators import forests, model, prep


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    made = rng.integers(0, 4, (4_000, 3))
    data = [(i, *map(float, x), float((x[0] > 1) != (x[1] > 2) if u < 0.9 else 0), float(x[0] * 10 + x[1])) for i, (x, u) in enumerate(zip(made, rng.random(4_000)))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, kind double, y double").repartition(3).cache()


@pytest.mark.parametrize("name, registry, label", [
    ("random_forest_classifier", model.CLASSIFIERS, "kind"), ("random_forest_regressor", model.REGRESSORS, "y"),
])
def test_a_forest_on_cells_is_one_on_rows(rows, tmp_path, monkeypatch, name, registry, label):
    monkeypatch.setattr(forests, "LEAST_ROWS", 1_000)
    pre = prep.fit_numeric_preprocessor(rows, ["a", "b", "c"])
    est = model.build_estimators({name: {"n_estimators": 12, "max_depth": 4}}, registry)[name]
    fitted = model.fit_models(pre, {name: est}, rows, label)[name]
    assert [type(s).__name__ for s in fitted.stages][-2] == "Bins" and fitted.stages[-1].getNumTrees == 12
    plain = est.fit(model.labelled(pre, rows, label))
    got = {r["id"]: r["prediction"] for r in model.predict(fitted, rows, ["id"]).collect()}
    want = {r["id"]: r["prediction"] for r in plain.transform(model.labelled(pre, rows, label, ["id"])).collect()}
    away = np.mean([abs(got[i] - want[i]) for i in want])
    assert len(got) == 4_000 and away < (0.02 if label == "kind" else 1.0)
    assert np.allclose(fitted.stages[-1].featureImportances.toArray(), plain.featureImportances.toArray(), atol=0.1)
    assert model.fit_models(pre, {name: est}, rows, label)[name].stages[-1].toDebugString.split("\n")[1:] == fitted.stages[-1].toDebugString.split("\n")[1:]
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert {r["id"]: r["prediction"] for r in model.predict(again, rows, ["id"]).collect()} == got


def test_draws_follow_the_rows_of_a_cell(spark):
    table = spark.createDataFrame([(float(i), 1.0, 50) for i in range(400)], "_bin_0 double, label double, _weight long")
    drawn = forests._draws(table, ["_bin_0", "label"], 3, 40, 7).select(*[f"_t{i}" for i in range(40)]).toPandas().to_numpy()
    assert abs(drawn.mean() - 50) < 0.5 and abs(drawn.var() - 50) < 3


def test_rows_are_kept_where_cells_do_not_help(rows, monkeypatch):
    vectors = model.labelled(prep.fit_numeric_preprocessor(rows, ["id", "a"]), rows, "y")
    est = model.build_estimators({"random_forest_regressor": {}}, model.REGRESSORS)["random_forest_regressor"]
    assert forests.fit(vectors, est) is None
    monkeypatch.setattr(forests, "LEAST_ROWS", 1_000)
    monkeypatch.setattr(forests, "ROWS_PER_CELL", 100)
    assert forests.fit(vectors, est) is None
