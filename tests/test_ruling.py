"""Rules held in tables, several groupings at once, kernel features and families."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sensorlens.operators import families, hinge, kernel, model, profile, range_join


def brute(values, rules):
    out = []
    for i, g, v in values:
        for r, h, lo, hi in rules:
            if g is not None and g == h and v is not None and not math.isnan(v) and (lo is None or lo <= v) and (hi is None or v <= hi):
                out.append((i, r))
    return sorted(out)


def test_range_join_as_brute_force(spark):
    rng = np.random.default_rng(3)
    values = [(i, "ab"[i % 2], float(v)) for i, v in enumerate(np.round(rng.normal(0, 50, 400), 1))]
    values += [(900, "a", None), (901, "a", math.nan), (902, None, 1.0), (903, "a", 0.0), (904, "a", -0.0), (905, "b", 1e300), (906, "b", math.inf)]
    rules = []
    for r in range(120):
        low = float(np.round(rng.normal(0, 60), 1))
        width = [0.0, 0.1, 1.0, 16.0, 64.0, 1e6][r % 6]
        rules.append((r, "ab"[r // 6 % 2], None if r % 17 == 0 else low, None if r % 13 == 0 else low + width))
    rules += [(500, "a", 5.0, 1.0), (501, "a", math.nan, 1.0), (502, None, 0.0, 1.0), (503, "b", -math.inf, math.inf), (504, "a", 0.0, 0.0)]
    v = spark.createDataFrame(values, "id long, g string, v double").repartition(3)
    r = spark.createDataFrame(rules, "rule long, g string, low double, high double")
    joined = range_join.range_join(v, r, "v", "low", "high", ["g"])
    assert sorted(map(tuple, joined.select("id", "rule").collect())) == brute(values, [x for x in rules if x[0] != 501])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert range_join.range_join(v, r.limit(0), "v", "low", "high", ["g"]).count() == 0
    assert range_join.range_join(v.limit(0), r, "v", "low", "high", ["g"]).count() == 0
    with pytest.raises(ValueError):
        range_join.range_join(v, r.withColumn("id", F.lit(1)), "v", "low", "high", ["g"])


def test_a_rule_touches_two_bins_at_most(spark):
    rng = np.random.default_rng(4)
    rules = [(i, float(a), float(a + b)) for i, (a, b) in enumerate(zip(rng.normal(0, 1e6, 500), 10 ** rng.uniform(-9, 9, 500)))]
    index = range_join.interval_index(spark.createDataFrame(rules, "rule long, low double, high double"), "low", "high", salts=1)
    sizes = [r["count"] for r in index.groupBy("rule").count().collect()]
    assert len(sizes) == 500 and max(sizes) <= 2
    spans = index.groupBy("rule").agg((F.max("_bin") - F.min("_bin")).alias("d")).agg(F.max("d")).first()[0]
    assert spans <= 1  # no bin between the two is left out


def test_violations_per_group(spark, frame):
    values = frame("g string, v double", ("a", 1.0), ("a", 5.0), ("a", None), ("b", 9.0))
    rules = frame("rule string, g string, low double, high double", ("x", "a", 0.0, 2.0), ("y", "b", None, 3.0), ("z", "c", 0.0, 1.0))
    got = {r["rule"]: (r["n"], r["outside"], r["outside_ratio"]) for r in range_join.rule_violations(values, rules, "v", "rule", "low", "high", ["g"]).collect()}
    assert got == {"x": (2, 1, 0.5), "y": (1, 1, 1.0), "z": (0, 0, None)}


def test_counts_per_rule_as_brute_force_without_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = [(int(i) if i < 90 else None, "ab"[k], float(v)) for i, k, v in zip(rng.integers(0, 100, 400), rng.integers(0, 2, 400), np.round(rng.normal(0, 50, 400)))]
    values += [(1, "a", None), (2, "a", math.nan), (3, None, 1.0), (4, "a", -0.0), (5, "b", math.inf), (6, "b", 1e300)]
    rules = [(r, "ab"[r % 2], None if r % 7 == 0 else float(low), None if r % 11 == 0 else float(low + w))
             for r, (low, w) in enumerate(zip(np.round(rng.normal(0, 50, 80)), np.round(rng.exponential(40, 80))))]
    rules += [(500, "a", 5.0, 1.0), (501, "a", math.nan, 1.0), (502, None, 0.0, 1.0), (503, "b", -math.inf, math.inf), (504, "a", 0.0, 0.0), rules[3], rules[4]]
    several = [*rules, (8, "a", -20.0, 30.0), (8, "a", 10.0, 60.0), (None, "b", 0.0, 9.0), (None, "b", 5.0, 20.0)]
    v = spark.createDataFrame(values, "id long, g string, v double").repartition(3)
    schema = "rule long, g string, low double, high double"

    def want(stated):
        met = {}
        for i, g, x in values:
            for r, h, lo, hi in stated:
                nan = r == 501 or x is not None and math.isnan(x)
                if g is not None and g == h and x is not None and not nan and (lo is None or lo <= x) and (hi is None or x <= hi):
                    met.setdefault(r, []).append((i, x))
        return {r: (len(m), len({i for i, _ in m if i is not None}), max(x for _, x in m)) for r, m in met.items()}

    def got(stated, rows=v):
        found = range_join.rule_counts(rows, spark.createDataFrame(stated, schema), "v", "rule", "low", "high", ["g"], "id")
        return {r["rule"]: (r["n"], r["n_distinct"], r["highest"]) for r in found.collect()}

    assert got(several) == want(several)
    monkeypatch.setattr(range_join, "range_join", None)  # one interval a rule: nothing is paired
    assert got(rules) == want(rules)
    assert got(rules, v.limit(0)) == {} and got([]) == {}
    stated = spark.createDataFrame(rules, schema)
    found = {r["rule"]: r for r in range_join.rule_violations(v, stated, "v", "rule", "low", "high", ["g"]).collect()}
    assert {r: f["n"] - f["outside"] for r, f in found.items() if f["n"] > f["outside"]} == {r: n for r, (n, _, _) in want(rules).items()}
    usable = sum(1 for _, g, x in values if g == "b" and not math.isnan(x))
    assert found[3]["n"] == 2 * usable and found[502]["n"] == 0 and found[500]["outside"] == found[500]["n"] > 0


def test_groupings_tell_missing_from_left_out(frame):
    df = frame("k string, v double", ("a", 0.0), ("a", 2.0), (None, 1.0), ("a", 9.0))
    got = profile.grouped_counts(df, "v", ["k"], [0.0, 1.0, 2.0], [["k", "bin"], ["k"], []])
    assert got._jdf.queryExecution().executedPlan().toString().count("Expand") == 1
    rows = {(r["k"], r["bin"], r["grouping"]): (r["n"], r["mean"]) for r in got.collect()}
    assert rows == {
        ("a", 0, 0): (1, 0.0), ("a", 1, 0): (1, 2.0), (None, 1, 0): (1, 1.0), ("a", None, 0): (1, 9.0),
        ("a", None, 1): (3, 11 / 3), (None, None, 1): (1, 1.0), (None, None, 3): (4, 3.0),
    }
    with pytest.raises(ValueError):
        profile.grouped_counts(df, "v", ["k"], [1.0, 0.0], [[]])


def rings(spark, n=600):
    rng = np.random.default_rng(6)
    turn, label = rng.uniform(0, 2 * np.pi, n), np.arange(n) % 2
    far = np.where(label == 1, 3.0, 1.0) + rng.normal(0, 0.2, n)
    rows = [(int(i), float(r * np.cos(t)), float(r * np.sin(t)), int(y)) for i, (r, t, y) in enumerate(zip(far, turn, label))]
    return spark.createDataFrame(rows, "id long, a double, b double, y int")


def test_rbf_machine_separates_rings(spark, tmp_path):
    from sensorlens.operators import prep

    df = rings(spark)
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    pre = prep.fit_numeric_preprocessor(train, ["a", "b"])
    share = {}
    for kind in ("linear", "rbf"):
        made = model.build_estimators({"svm_classifier": {"kernel": kind, "C": 10.0, "n_components": 100}})
        fitted = model.fit_models(pre, made, train, "y")["svm_classifier"]
        share[kind] = model.predict(fitted, test, ["y"]).filter("y = prediction").count() / test.count()
    assert share["rbf"] > 0.95 and share["rbf"] > share["linear"] + 0.3
    fitted.write().overwrite().save(str(tmp_path / "rbf"))
    again = PipelineModel.load(str(tmp_path / "rbf"))
    assert sorted(model.predict(again, test, ["id"]).collect()) == sorted(model.predict(fitted, test, ["id"]).collect())
    with pytest.raises(ValueError):
        model.build_estimators({"svm_classifier": {"kernel": "poly"}})


def test_linear_machine_reaches_the_least_loss(spark):
    """Labels that features say nothing about, of which a search along the hinge's slopes stopped at a loss of 8.7."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20000, 5))
    y = (rng.random(len(x)) < 1 / 3).astype(float)
    df = spark.createDataFrame([(Vectors.dense(a), b) for a, b in zip(x.tolist(), y.tolist())], ["features", "label"])
    made = model.build_estimators({"svm_classifier": {"C": 1.0}})["svm_classifier"]
    made = made.copy({made.regParam: 1 / len(x)})
    fitted = made.fit(df)
    loss = np.maximum(0, 1 - (2 * y - 1) * (x @ fitted.coefficients.toArray() + fitted.intercept)).mean()
    assert loss == pytest.approx(2 * y.mean(), abs=1e-4)
    clear = df.withColumn("label", (F.get(vector_to_array("features"), 1) * 100 > 3).cast("double"))
    split = made.fit(clear).transform(clear)
    assert split.filter("label = prediction").count() > 0.999 * len(x)
    with pytest.raises(ValueError):
        made.fit(df.withColumn("label", F.lit(2.0)))
    with pytest.raises(ValueError):
        made.fit(df.limit(0))


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(30, 4))
    df = spark.createDataFrame([(Vectors.dense(p),) for p in points.tolist()], ["features"])
    lifted = kernel.FourierFeatures(4, 0.2, 2_000).transform(df).collect()
    made = np.array([r["_fourier"].toArray() for r in lifted])
    own = np.array([r["features"].toArray() for r in lifted])
    exact = np.exp(-0.2 * ((own[:, None] - own[None]) ** 2).sum(axis=2))
    assert np.abs(made @ made.T - exact).max() < 0.12 and np.abs(made @ made.T - exact).mean() < 0.02


def test_kernel_features_are_made_in_batches(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(Vectors.dense(v),) for v in rng.normal(size=(50, 3))], ["features"])
    stage = kernel.FourierFeatures(3, 0.5, 20)
    made = stage.transform(df)
    assert "ArrowEvalPython" in made._jdf.queryExecution().executedPlan().toString()  # no interpreted function per row and draw
    turns, offsets = stage.weights()
    for r in made.collect():
        want = np.cos(turns @ r["features"].toArray() + offsets) * np.sqrt(2 / 20)
        assert np.abs(r["_fourier"].toArray() - want).max() < 1e-12
    assert stage.transform(df.limit(0)).count() == 0


def test_a_kernel_machine_keeps_rows_and_not_their_features(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(Vectors.dense(v), float(v @ v > 2.5)) for v in x], ["features", "label"]).repartition(2)
    kept, minimise = [], hinge.minimise
    monkeypatch.setattr(hinge, "minimise", lambda blocks, *a: (kept.append(blocks.agg(F.sum(F.length("rows"))).first()[0]), minimise(blocks, *a))[1])
    made = kernel.KernelMachine(hinge.HingeMachine(regParam=0.01), 0.5, 50).fit(df)
    assert kept == [400 * 4 * 8]  # three components and a sign, where 50 features and a constant were kept
    lifted = kernel.FourierFeatures(3, 0.5, 50).transform(df)
    plain = hinge.HingeMachine(regParam=0.01, featuresCol="_fourier").fit(lifted)
    assert np.allclose(made.stages[1].coefficients.toArray(), plain.coefficients.toArray(), rtol=1e-4, atol=1e-4)
    assert made.stages[1].intercept == pytest.approx(plain.intercept, abs=1e-4)


@pytest.mark.parametrize("kind", ["norm", "t", "gamma"])
def test_families_are_recovered(spark, kind):
    rng = np.random.default_rng(5)
    x = {"norm": rng.normal(5, 2, 6000), "t": 1 + 2 * rng.standard_t(3, 6000), "gamma": rng.gamma(2.5, 4.0, 6000)}[kind]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(-1, None), (-2, math.nan)], "id long, x double")
    tried = ["norm", "t"] if kind == "t" else ["norm", "gamma"]  # t comes as near to normal rows as normal itself
    best, report = families.choose_family(df, "x", families=tried)
    rows = {r["family"]: r for r in report.collect()}
    assert best.family == kind and {r["n_train"] + r["n_held"] for r in rows.values()} == {6000}
    if "gamma" in tried:
        assert (rows["gamma"]["log_likelihood"] is None) == (x.min() <= 0)
    want = {"norm": (5, 2, None), "t": (1, 2, 3), "gamma": (0, 4, 2.5)}[kind]
    assert best.loc == pytest.approx(want[0], abs=0.15) and best.scale == pytest.approx(want[1], rel=0.08)
    assert best.shape is None or best.shape == pytest.approx(want[2], rel=0.15)


def test_digamma_and_constant_columns(frame):
    assert families.digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert families.digamma(0.1) == pytest.approx(-10.423754940411076, abs=1e-11)
    best, report = families.choose_family(frame("id long, x double", *[(i, 3.0) for i in range(20)]), "x")
    assert best is None and report.filter("log_likelihood is null").count() == 3
    with pytest.raises(ValueError):
        families.choose_family(frame("id long, x double", (1, 1.0)), "x", families=["beta"])
