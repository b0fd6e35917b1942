import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlens.plans import modelling
from sensorlens.operators import evaluate, explain, model, prep, split
from sensorlens.plans import workflow
from sensorlens.sources import sinks


@pytest.fixture()
def confusion(frame):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2
    return frame("label int, prediction int", *pairs)


def test_scores_by_hand(confusion):
    heads = evaluate.headline_scores(evaluate.confusion_counts(confusion)).first()
    assert heads["accuracy"] == 0.625
    assert heads["f1_weighted"] == pytest.approx(0.619048, abs=1e-6)
    report = {r["class"]: r for r in evaluate.classification_report(confusion).collect()}
    assert report["0"]["f1"] == pytest.approx(2 / 3) and report["1"]["f1"] == pytest.approx(4 / 7)
    assert report["macro avg"]["f1"] == pytest.approx(0.619048, abs=1e-6)
    assert report["weighted avg"]["support"] == 8


def test_confusion_shares(confusion):
    shares = {(r.label, r.prediction): r.share for r in evaluate.confusion_matrix(confusion).collect()}
    assert shares == {(0, 0): 0.75, (0, 1): 0.25, (1, 1): 0.5, (1, 0): 0.5}
    total = evaluate.confusion_matrix(confusion, normalize="all").agg(F.sum("share")).first()[0]
    assert total == pytest.approx(1.0)
    with pytest.raises(ValueError):
        evaluate.confusion_matrix(confusion, normalize="rows")


def test_class_never_predicted(frame):
    df = frame("label int, prediction int", (0, 0), (1, 0))
    r = {x["class"]: x for x in evaluate.classification_report(df).collect()}["1"]
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_first_listed_model_wins_ties(frame):
    metrics = frame("model string, model_ordinal int, f1_weighted double, accuracy double",
                    ("b", 1, 0.9, 0.9), ("a", 0, 0.9, 0.9), ("c", 2, 0.1, 0.9))
    assert evaluate.best_model(metrics).first()["model"] == "a"
    ranks = {r.model: r["rank"] for r in evaluate.compare_models(metrics).collect()}
    assert ranks == {"a": 1, "b": 2, "c": 3}
    go = {r.model: r.go for r in evaluate.go_no_go(metrics).collect()}
    assert go == {"a": True, "b": True, "c": False}


def test_baselines_and_leakage(frame):
    train = frame("id int, y int, t int", (1, 0, 1), (2, 1, 2), (3, 1, 9))
    test = frame("id int, y int, t int", (3, 0, 5), (4, 1, 8))
    assert evaluate.baseline_prediction(train, test, "y").first()["prediction"] == 1.0
    mean = evaluate.baseline_prediction(train, test, "y", "naive_mean").first()["prediction"]
    assert mean == pytest.approx(2 / 3)
    checks = evaluate.leakage_detection(train, test, ["t", "y"], "y", "id", "t").collect()
    assert [(r.check, r.findings) for r in checks] == [
        ("target_in_features", 1), ("train_test_overlap", 1), ("time_leakage", 1)]


def test_reproducibility(spark):
    df = spark.range(50)
    assert evaluate.reproducibility_check(df, df.repartition(3)).first()["identical"]
    assert not evaluate.reproducibility_check(df, df.withColumn("id", F.col("id") + 1)).first()["identical"]
    doubled = df.union(df)
    assert not evaluate.reproducibility_check(doubled, doubled.filter("id > 0").union(spark.range(0, 2))).first()["identical"]


def test_registry_refuses_nothing_and_unknown():
    with pytest.raises(ValueError):
        model.build_estimators({})
    with pytest.raises(ValueError):
        model.build_estimators({"perceptron": None})
    with pytest.raises(ValueError):
        model.build_estimators({"decision_tree_classifier": {"leaves": 3}})


def test_registry_defaults(spark):
    built = model.build_estimators(workflow.DEFAULT_MODELS)
    forest = built["random_forest_classifier"]
    assert list(built) == ["decision_tree_classifier", "random_forest_classifier"]
    assert (forest.getNumTrees(), forest.getSeed(), forest.getMaxDepth()) == (100, 42, 30)


@pytest.fixture(scope="module")
def sensors(spark):
    """X with one telling feature, one useless one, a constant and a copy; Y decided by the telling one."""
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(2, 900))
    x = [(i, float(v) if i % 40 else None, float(w), 1.0, float(w)) for i, (v, w) in enumerate(zip(a, b))]
    y = [(i, int(v > 0.2), float(3 * v)) for i, v in enumerate(a)]
    return (spark.createDataFrame(x, "id long, a double, b double, c double, d double"),
            spark.createDataFrame(y, "id long, faulty int, margin double"))


@pytest.fixture(scope="module")
def prepared(sensors):
    return workflow.prepare(*sensors, drop_after_join=["margin", "id"])


@pytest.fixture(scope="module")
def modelled(prepared):
    return workflow.fit_and_score(prepared, {
        "decision_tree_classifier": {"max_depth": 4},
        "random_forest_classifier": {"n_estimators": 10, "max_depth": 4}})


def test_prepare(prepared):
    assert prepared.features == ["a", "b"]
    assert prepared.train.count() + prepared.test.count() == 900
    assert [r.cols_removed for r in prepared.kpi.collect()] == [1, 1]
    assert [r["column"] for r in prepared.changes.collect()] == ["c", "d"]


def test_models_learn_and_best_is_chosen(modelled):
    rows = {r.model: r for r in modelled.metrics.collect()}
    assert all(r.accuracy > 0.9 and 0 <= r.f1_weighted <= 1 for r in rows.values())
    assert rows[modelled.best.name].f1_weighted == max(r.f1_weighted for r in rows.values())


def test_interpretation(prepared, modelled):
    found = workflow.interpret(prepared, modelled, n_repeats=3)
    impurity = found["feature_importance"].collect()
    assert impurity[0]["feature"] == "a"
    assert sum(r["importance"] for r in impurity) == pytest.approx(1.0)
    permuted = {r["feature"]: r["importance_mean"] for r in found["permutation_importance"].collect()}
    assert permuted["a"] > 0.3 and abs(permuted["b"]) < 0.1
    by_label = found["confusion_matrix"].groupBy("label").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in by_label)


def test_permutation_is_repeatable_and_complete(spark):
    rows = spark.range(500).select("id", (F.col("id") % 5).alias("a"), F.col("id").alias("b")).coalesce(3)
    copies = explain.shuffled_copies(rows, ["a", "b"], 2, 42, ["id"], group_rows=60)
    got = copies.select("repeat", "id", F.col("partner.b").alias("b")).collect()
    for repeat in (0, 1):
        mine = [(r.id, r.b) for r in got if r["repeat"] == repeat]
        assert sorted(i for i, _ in mine) == sorted(b for _, b in mine) == list(range(500))
        assert all(i != b for i, b in mine)
        assert abs(np.corrcoef(np.array(mine).T)[0, 1]) < 0.2


def test_saved_model_predicts_the_same(tmp_path, prepared, modelled):
    best = modelled.best.model
    sinks.save_model(best, str(tmp_path / "best"))
    again = sinks.load_model(str(tmp_path / "best"))
    first = model.batch_scoring(best, prepared.test)
    assert evaluate.reproducibility_check(first, model.batch_scoring(again, prepared.test)).first()["identical"]
    sinks.write_predictions(first, str(tmp_path / "submission"))
    back = prepared.test.sparkSession.read.json(str(tmp_path / "submission"))
    assert back.columns == ["id", "prediction"] and back.count() == first.count()


def test_documents(tmp_path, spark, prepared, modelled):
    doc = sinks.metrics_document(modelled.report, modelled.best.name)
    sinks.write_document(doc, str(tmp_path / "metrics"))
    (part,) = list((tmp_path / "metrics").glob("*.json"))
    loaded = json.loads(part.read_text())
    entry = loaded["results"]["decision_tree_classifier"]
    assert loaded["best_model"] == modelled.best.name
    assert set(entry["classification_report"]) == {"0", "1", "macro avg", "weighted avg"}
    assert 0.9 < entry["accuracy"] <= 1 and "f1-score" in entry["classification_report"]["0"]
    importance = model.feature_importance(modelled.best.model, prepared.features)
    permutation = spark.createDataFrame([("b", 0.1), ("a", 0.4)], "feature string, importance_mean double")
    sinks.write_document(sinks.interpretation_document(importance, permutation), str(tmp_path / "i"))
    (part,) = list((tmp_path / "i").glob("*.json"))
    lists = json.loads(part.read_text())
    assert [e["feature"] for e in lists["permutation_importance"]] == ["a", "b"]
    assert lists["feature_importance"][0]["feature"] == "a"


def test_linear_models(sensors):
    x, y = sensors
    df = x.join(y, "id").dropna()
    pre = prep.fit_numeric_preprocessor(df, ["a", "b"])
    chosen = model.build_estimators({"linear_regression": {}, "polynomial_regression": {"degree": 2}}, model.REGRESSORS)
    fitted = model.fit_models(pre, chosen, df, "margin")
    scores = evaluate.regression_scores(model.score_models(fitted, df, "margin"), by=["model"]).collect()
    assert all(r.rmse < 1e-3 for r in scores)
    weights = model.coefficients(fitted["linear_regression"], ["a", "b"]).collect()
    assert weights[0]["feature"] == "a" and weights[0]["coefficient"] > 2
    assert model.feature_importance(fitted["linear_regression"], ["a", "b"]) is None
    line = explain.partial_dependence(fitted["linear_regression"], df, ["a", "b"], 5, 1).orderBy("grid_value").collect()
    steps = np.diff([r.mean_prediction for r in line])
    assert len(line) == 5 and steps == pytest.approx([steps[0]] * 4)


def test_search_and_folds(sensors):
    x, y = sensors
    df = x.join(y, "id")
    pre = prep.fit_numeric_preprocessor(df, ["a", "b"])
    vectors = model.labelled(pre, df, "faulty", ["id"])
    tree = model.build_estimators({"decision_tree_classifier": {"max_depth": 2}})["decision_tree_classifier"]
    found = model.hyperparameter_search(tree, {"maxDepth": [1, 3]}, vectors, folds=2)
    assert model.search_report(found, "f1_weighted").count() == 2
    picked = model.hyperparameter_search(tree, {"maxDepth": [1, 2, 3]}, vectors, strategy="random", n_iter=1, folds=2)
    assert len(picked.avgMetrics) == 1
    folds = model.cross_validate(tree, vectors, folds=3).collect()
    assert [r.fold for r in folds] == [0, 1, 2] and sum(r.support for r in folds) == 900
    with pytest.raises(ValueError):
        model.hyperparameter_search(tree, {"maxDepth": [1]}, vectors, strategy="bayes")


def test_normal_regression(sensors):
    x, y = sensors
    df = x.join(y, "id").dropna().withColumn("margin", F.col("margin") + F.sin(F.col("id") * 12.9898) * 2)
    pre = prep.fit_numeric_preprocessor(df, ["a", "b"])
    linear = model.build_estimators({"linear_regression": {}}, model.REGRESSORS)["linear_regression"]
    rows = model.fit_probabilistic_regression(pre, linear, df, "margin").transform(df, ["id", "margin"]).collect()
    assert {r.distribution for r in rows} == {"norm"} and all(r.scale > 0 for r in rows)
    within = np.mean([abs(r.margin - r.loc) < 2 * r.scale for r in rows])
    assert within > 0.9


def test_split_is_made_on_keys(prepared):
    assert prepared.train.join(prepared.test, "id", "left_semi").count() == 0
    assert isinstance(split.HoldoutConfig(), split.HoldoutConfig)


class _Stop(Exception):
    pass


def _asked(spark, sf_dir, monkeypatch, name, fn):
    """What a registered query hands to the library; nothing is trained."""
    held = {}
    real = getattr(model, name)

    def catch(*args, **kwargs):
        held["args"], held["kwargs"] = args, kwargs
        if name == "build_estimators":
            held["made"] = real(*args, **kwargs)
        raise _Stop

    monkeypatch.setattr(modelling.model, name, catch)
    try:
        getattr(modelling, fn)(spark, sf_dir)
    except _Stop:
        pass
    return held


def test_registered_searches_try_the_whole_grid_on_five_folds(spark, sf_dir, monkeypatch):
    grid = _asked(spark, sf_dir, monkeypatch, "search_pipeline", "b64")["args"][3]
    assert {(p["max_depth"], p["min_samples_leaf"]) for _, p in grid} == {(d, n) for d in (3, 5, 10, None) for n in (1, 5, 10)}
    monkeypatch.undo()
    drawn = modelling.b65(spark, sf_dir)
    assert drawn.select("candidate").distinct().count() == 30 and drawn.count() == 150 and len(sum(modelling.MANY.values(), [])) > 30


def test_registered_regressors_have_the_reference_counts(spark, sf_dir, monkeypatch):
    trees = _asked(spark, sf_dir, monkeypatch, "build_estimators", "b62")["made"]
    assert trees["random_forest_regressor"].getNumTrees() == 200
    assert trees["decision_tree_regressor"].getMaxDepth() == model.MAX_TREE_DEPTH
    assert trees["random_forest_regressor"].getMaxDepth() == 10  # without a limit it does not end, see README
    monkeypatch.undo()
    boosted = _asked(spark, sf_dir, monkeypatch, "build_estimators", "b63")["made"]["boosted_trees_regressor"]
    assert boosted.getMaxIter() == 300
