"""Queries over evaluation, models, interpretation and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators import bayes, evaluate, explain, fold_sums, model, prep, split
from sensorlens.plans import workflow
from sensorlens.plans.catalog import query
from sensorlens.plans.tables import FEATURES, SCORED_SQL, X_MISSING_SQL, X_SQL, XY_SQL, Y_SQL
from sensorlens.plans.tables import digest_sql, features_x, joined_xy, labels_y, rule_scored, table, x_missing

TEST = f"({digest_sql('id')} < '33333333')"


def rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- scores of a rule, which SQL can compute too -----------------------------------------

CLASS_SQL = """(select g.model, g.class, count(*) filter (s.label = g.class) as support,
 count(*) filter (s.prediction = g.class) as predicted, count(*) filter (s.label = g.class and s.prediction = g.class) as hits
 from ({scored}) s, (select distinct model, class from (select model, label as class from ({scored}) union all select model, prediction from ({scored}))) g
 where s.model = g.model group by 1, 2)"""
ONE_RULE = f"select 'rule' as model, label, prediction from {SCORED_SQL}"
TWO_RULES = f"""select 'rule_a' as model, label, prediction from {SCORED_SQL}
 union all select 'rule_b', label, prediction_b from {SCORED_SQL}"""


def scores_sql(scored: str) -> str:
    return f"""(select model, class, support, hits,
 coalesce(hits::double / nullif(predicted, 0), 0) as p, coalesce(hits::double / nullif(support, 0), 0) as r,
 coalesce(2.0::double * hits / nullif(predicted + support, 0), 0) as f from {CLASS_SQL.format(scored=scored)})"""


HEADLINE = """sum(hits)::double / sum(support) as accuracy, sum(f * support)::double / sum(support) as f1_weighted"""


@query("a57_accuracy", f"select round(sum(hits)::double / sum(support), 6) as accuracy from {scores_sql(ONE_RULE)}")
def a57(spark, sf_dir):
    return rounded(evaluate.accuracy(rule_scored(spark, sf_dir)), "accuracy")


@query("a58_f1_weighted", f"select round(sum(f * support)::double / sum(support), 6) as f1_weighted from {scores_sql(ONE_RULE)}")
def a58(spark, sf_dir):
    return rounded(evaluate.f1_weighted(rule_scored(spark, sf_dir)), "f1_weighted")


@query("a59_classification_report", f"""with s as materialized (select * from {scores_sql(ONE_RULE)})
 select class::varchar as class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, support from s
 union all select 'accuracy', a, a, a, n from (select round(sum(hits)::double / sum(support), 6) as a, sum(support)::bigint as n from s)
 union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::bigint from s
 union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
 round(sum(f * support) / sum(support), 6), sum(support)::bigint from s""")
def a59(spark, sf_dir):
    return rounded(evaluate.classification_report(rule_scored(spark, sf_dir)), "precision", "recall", "f1")


def _two_rules(spark, sf_dir):
    s = rule_scored(spark, sf_dir)
    return s.select("label", F.inline(F.array(
        F.struct(F.lit("rule_a").alias("model"), F.lit(0).alias("model_ordinal"), "prediction"),
        F.struct(F.lit("rule_b").alias("model"), F.lit(1).alias("model_ordinal"), F.col("prediction_b").alias("prediction")))))


def _two_metrics(spark, sf_dir):
    by = ["model", "model_ordinal"]
    return evaluate.headline_scores(evaluate.confusion_counts(_two_rules(spark, sf_dir), by=by), by)


METRICS_SQL = f"""(select model, case model when 'rule_a' then 0 else 1 end as model_ordinal, {HEADLINE} from {scores_sql(TWO_RULES)} group by model)"""


@query("a60_best_model", f"""select model, round(accuracy, 6) as accuracy, round(f1_weighted, 6) as f1_weighted
 from {METRICS_SQL} m order by m.f1_weighted desc, model_ordinal limit 1""")
def a60(spark, sf_dir):
    best = evaluate.best_model(_two_metrics(spark, sf_dir)).select("model", "accuracy", "f1_weighted")
    return rounded(best, "accuracy", "f1_weighted")


CONFUSION_SQL = f"select label, prediction, count(*) as n from {SCORED_SQL} group by 1, 2"


@query("a63_confusion_true", f"select *, round(n::double / sum(n) over (partition by label), 6) as share from ({CONFUSION_SQL})")
def a63(spark, sf_dir):
    return rounded(evaluate.confusion_matrix(rule_scored(spark, sf_dir)), "share")


@query("a63_confusion_pred", f"select *, round(n::double / sum(n) over (partition by prediction), 6) as share from ({CONFUSION_SQL})")
def a63_pred(spark, sf_dir):
    return rounded(evaluate.confusion_matrix(rule_scored(spark, sf_dir), normalize="pred"), "share")


@query("a63_confusion_all", f"select *, round(n::double / sum(n) over (), 6) as share from ({CONFUSION_SQL})")
def a63_all(spark, sf_dir):
    return rounded(evaluate.confusion_matrix(rule_scored(spark, sf_dir), normalize="all"), "share")


REGRESSION_SQL = f"""(select id, margin as label, price as guess_a, 100000.0::double + n_lines * 10000 as guess_b from {XY_SQL})"""


def _two_guesses(spark, sf_dir):
    guess_a = F.struct(F.lit("guess_a").alias("model"), F.lit(0).alias("model_ordinal"), F.col("price").alias("prediction"))
    guess_b = F.struct(F.lit("guess_b").alias("model"), F.lit(1).alias("model_ordinal"),
                       (F.lit(100000.0) + F.col("n_lines") * 10000).alias("prediction"))
    return joined_xy(spark, sf_dir).select(F.col("margin").alias("label"), F.inline(F.array(guess_a, guess_b)))


@query("b68_rmse_mae_ranked", f"""with m as (select 'guess_a' as model, 0 as model_ordinal, sqrt(avg((guess_a - label) ** 2)) as rmse, avg(abs(guess_a - label)) as mae, count(*) as support from {REGRESSION_SQL}
 union all select 'guess_b', 1, sqrt(avg((guess_b - label) ** 2)), avg(abs(guess_b - label)), count(*) from {REGRESSION_SQL})
 select model, model_ordinal, round(rmse, 3) as rmse, round(mae, 3) as mae, support, cast(row_number() over (order by rmse, mae, model_ordinal) as integer) as "rank" from m""")
def b68(spark, sf_dir):
    m = evaluate.regression_scores(_two_guesses(spark, sf_dir), by=["model", "model_ordinal"])
    return rounded(evaluate.rank_regressors(m), "rmse", "mae", digits=3)


@query("b71_compare_models", f"""select model, model_ordinal, round(accuracy, 6) as accuracy, round(f1_weighted, 6) as f1_weighted,
 cast(row_number() over (order by f1_weighted desc, accuracy desc, model_ordinal) as integer) as "rank" from {METRICS_SQL}""")
def b71(spark, sf_dir):
    ranked = evaluate.compare_models(_two_metrics(spark, sf_dir)).drop("f1_macro", "support")
    return rounded(ranked, "accuracy", "f1_weighted")


BASELINE_ROWS = f"""select 'majority' as model, faulty as label, (select faulty from {Y_SQL} where not {TEST} group by 1 order by count(*) desc, faulty limit 1) as prediction
 from {Y_SQL} where {TEST}"""


@query("b72_baseline_majority", f"select round(sum(hits)::double / sum(support), 6) as accuracy, round(sum(f * support)::double / sum(support), 6) as f1_weighted from {scores_sql(BASELINE_ROWS)}")
def b72(spark, sf_dir):
    train, test = split.split_holdout(labels_y(spark, sf_dir), None, split.BY_THRESHOLD)
    scored = evaluate.baseline_prediction(train, test, "faulty")
    heads = evaluate.headline_scores(evaluate.confusion_counts(scored, "faulty"))
    return rounded(heads.select("accuracy", "f1_weighted"), "accuracy", "f1_weighted")


@query("b72_baseline_mean", f"""select round(sqrt(avg((margin - m) ** 2)), 3) as rmse, round(avg(abs(margin - m)), 3) as mae, count(*) as support
 from {Y_SQL}, (select avg(margin) as m from {Y_SQL} where not {TEST}) where {TEST}""")
def b72_mean(spark, sf_dir):
    train, test = split.split_holdout(labels_y(spark, sf_dir), None, split.BY_THRESHOLD)
    scored = evaluate.baseline_prediction(train, test, "margin", "naive_mean")
    return rounded(evaluate.regression_scores(scored, "margin"), "rmse", "mae", digits=3)


@query("b73_business_kpis", f"""select sum(case when label = 1 and prediction = 0 then n * 500 else 0 end)::double as missed_fault_cost,
 sum(case when label = 0 and prediction = 1 then n * 40 else 0 end)::double as needless_check_cost,
 round(sum(case when prediction = 1 then n end)::double / sum(n), 6) as inspected_share from ({CONFUSION_SQL})""")
def b73(spark, sf_dir):
    kpis = {
        "missed_fault_cost": "sum(if(label = 1 and prediction = 0, n * 500, 0))",
        "needless_check_cost": "sum(if(label = 0 and prediction = 1, n * 40, 0))",
        "inspected_share": "sum(if(prediction = 1, n, 0)) / sum(n)",
    }
    counts = evaluate.confusion_counts(rule_scored(spark, sf_dir))
    return rounded(evaluate.business_kpis(counts, kpis), "inspected_share")


@query("b74_leakage_detection", f"""select 'target_in_features' as "check", 1::bigint as findings, false as passed
 where exists (select 1 from {Y_SQL}) union all
 select 'train_test_overlap', count(*), count(*) = 0 from (select user_id from events where event_id in (select event_id from tr)
 intersect select user_id from events where event_id not in (select event_id from tr)) union all
 select 'time_leakage', count(*), count(*) = 0 from tr where ts >= (select min(ts) from events where event_id not in (select event_id from tr))"""
       .replace("from tr", "from (select event_id, ts from events where not (substr(md5(cast(event_id as varchar) || ':42'), 1, 8) < '33333333'))"))
def b74(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    train, test = split.split_holdout(events, None, split.HoldoutConfig(stratify=False, exact=False, key="event_id"))
    return evaluate.leakage_detection(train, test, ["value", "event_type"], "value", "user_id", "ts")


@query("b75_go_no_go", f"""select model, round(accuracy, 6) as accuracy, round(f1_weighted, 6) as f1_weighted,
 accuracy >= 0.7::double and f1_weighted >= 0.65::double as go from {METRICS_SQL}""")
def b75(spark, sf_dir):
    decided = evaluate.go_no_go(_two_metrics(spark, sf_dir)).select("model", "accuracy", "f1_weighted", "go")
    return rounded(decided, "accuracy", "f1_weighted")


@query("b77_reproducibility_check", f"""select count(*) filter (not {TEST}) as rows_first, count(*) filter (not {TEST}) as rows_second, true as identical from {Y_SQL}""")
def b77(spark, sf_dir):
    y = labels_y(spark, sf_dir)
    first, _ = split.split_holdout(y, None, split.BY_THRESHOLD)
    again, _ = split.split_holdout(y.repartition(7), None, split.BY_THRESHOLD)
    return evaluate.reproducibility_check(first, again)


# --- models ------------------------------------------------------------------------------

def _naive_bayes_sql(raised: str = "0") -> str:
    fit = ", ".join(f"avg({c}) as m_{c}, var_pop({c}) + any_value(raised) as v_{c}" for c in FEATURES)
    score = "ln(n / total)" + "".join(f" - 0.5 * ln(v_{c}) - ({c} - m_{c}) ** 2 / (2 * v_{c})" for c in FEATURES)
    return f"""with xy as materialized (select * from {XY_SQL}),
 t as (select *, {raised} as raised from xy where not {TEST}),
 g as (select faulty as cls, count(*)::double as n, sum(count(*)) over () as total, {fit} from t group by 1)
 select id, faulty, arg_max(cls, {score})::double as prediction from xy, g where {TEST} group by 1, 2"""


# Trees of a forest are grown level by level together: without a limit on the depth the forest
# takes minutes even on small tables, so here it has one. The single tree has none.
TREES = {
    "decision_tree_classifier": {"random_state": 42},
    "random_forest_classifier": {"n_estimators": 100, "max_depth": 6, "random_state": 42, "n_jobs": -1},
}


def _prepared(spark, sf_dir, holdout=None):
    x, y = features_x(spark, sf_dir), labels_y(spark, sf_dir)
    return workflow.prepare(x, y, drop_after_join=["margin"], holdout=holdout)


def _fitted(spark, sf_dir, name, params=None, registry=model.CLASSIFIERS, label="faulty", scaling="standard"):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, FEATURES, prep.PreprocessConfig(scaling=scaling))
    estimators = model.build_estimators({name: params}, registry)
    return model.fit_models(pre, estimators, train, label)[name], train, test


def _predictions(spark, sf_dir, name, params=None, registry=model.CLASSIFIERS, label="faulty"):
    fitted, _, test = _fitted(spark, sf_dir, name, params, registry, label)
    return model.predict(fitted, test, ["id", label])


def _predictions_of(spark, sf_dir, name, params, registry, label, scaling):
    fitted, _, test = _fitted(spark, sf_dir, name, params, registry, label, scaling)
    return model.predict(fitted, test, ["id", label])


@query("a52_decision_tree")
def a52(spark, sf_dir):
    return _predictions(spark, sf_dir, "decision_tree_classifier", TREES["decision_tree_classifier"])


@query("a53_random_forest")
def a53(spark, sf_dir):
    return _predictions(spark, sf_dir, "random_forest_classifier", TREES["random_forest_classifier"])


@query("a55_fit_and_score_models")
def a55(spark, sf_dir):
    return workflow.fit_and_score(_prepared(spark, sf_dir), TREES).metrics


def _bayes_metrics_sql() -> str:
    scored = f"select 'naive_bayes_classifier' as model, faulty as label, prediction::integer as prediction from ({_naive_bayes_sql()})"
    return f"""select model, round(sum(hits)::double / sum(support), 6) as accuracy,
 round(sum(f * support)::double / sum(support), 6) as f1_weighted, sum(support)::bigint as support from {scores_sql(scored)} group by model"""


@query("a55_workflow_bayes", _bayes_metrics_sql())
def a55_bayes(spark, sf_dir):
    done = workflow.fit_and_score(_prepared(spark, sf_dir, split.BY_THRESHOLD), {"naive_bayes_classifier": {}})
    return rounded(done.metrics.select("model", "accuracy", "f1_weighted", "support"), "accuracy", "f1_weighted")


@query("a56_predict_report")
def a56(spark, sf_dir):
    return workflow.fit_and_score(_prepared(spark, sf_dir), TREES).report


@query("a61_feature_importance")
def a61(spark, sf_dir):
    fitted, _, _ = _fitted(spark, sf_dir, "random_forest_classifier", TREES["random_forest_classifier"])
    return model.feature_importance(fitted, FEATURES)


@query("a64_permutation_importance")
def a64(spark, sf_dir):
    fitted, _, test = _fitted(spark, sf_dir, "random_forest_classifier", TREES["random_forest_classifier"])
    return explain.permutation_importance(fitted, test, "faulty", FEATURES, n_repeats=10)


# A tree of one split over few different values is the best cut by impurity: SQL can state it.
STUMP = {"max_depth": 1}


def _stump(spark, sf_dir, name, registry, label, params):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, ["n_lines"], prep.PreprocessConfig(scaling="none"))
    fitted = model.fit_models(pre, model.build_estimators({name: params}, registry), train, label)[name]
    return fitted, model.predict(fitted, test, ["id", label])


def _stump_sql(label: str, impurity: str, left: str, right: str) -> str:
    """Best cut of n_lines: nl rows and a label sum of sl up to the cut, n and s in all."""
    return f"""with xy as materialized (select id, n_lines, {label}, {TEST} as held from {XY_SQL}),
 per as (select n_lines as v, count(*)::double as n, sum({label})::double as s from xy where not held group by 1),
 cuts as (select v as cut, sum(n) over (order by v) as nl, sum(s) over (order by v) as sl, sum(n) over () as n, sum(s) over () as s from per),
 best as (select * from cuts where nl < n order by {impurity}, cut limit 1)
 select id, {label}, round(case when n_lines <= cut then {left} else {right} end::double, 2) as prediction from xy, best where held"""


_CLASS_STUMP = _stump_sql(
    "faulty",
    "nl - (sl * sl + (nl - sl) * (nl - sl)) / nl + (n - nl) - ((s - sl) * (s - sl) + (n - nl - s + sl) * (n - nl - s + sl)) / (n - nl)",
    "cast(sl * 2 > nl as integer)", "cast((s - sl) * 2 > n - nl as integer)")
_VALUE_STUMP = _stump_sql("margin", "- sl * sl / nl - (s - sl) * (s - sl) / (n - nl)", "sl / nl", "(s - sl) / (n - nl)")


@query("a52_decision_stump", _CLASS_STUMP)
def a52_stump(spark, sf_dir):
    return _stump(spark, sf_dir, "decision_tree_classifier", model.CLASSIFIERS, "faulty", STUMP)[1]


@query("a53_forest_of_one_stump", _CLASS_STUMP)
def a53_stump(spark, sf_dir):
    one = {"n_estimators": 1, "bootstrap": False, "max_features": "all", **STUMP}
    return _stump(spark, sf_dir, "random_forest_classifier", model.CLASSIFIERS, "faulty", one)[1]


@query("a61_importance_of_one_split", "select 'n_lines' as feature, 1.0::double as importance from orders limit 1")
def a61_stump(spark, sf_dir):
    fitted, _ = _stump(spark, sf_dir, "decision_tree_regressor", model.REGRESSORS, "margin", STUMP)
    return model.feature_importance(fitted, ["n_lines"])


_GAINS = " union all ".join(
    f"""select '{c}' as feature, max(sl * sl / nl + (s - sl) * (s - sl) / (n - nl)) as gain from (
 select sum(n) over (order by v) as nl, sum(s) over (order by v) as sl, sum(n) over () as n, sum(s) over () as s from (
  select {c} as v, count(*)::double as n, sum(margin)::double as s from xy group by 1)) where nl < n"""
    for c in ("n_lines", "qty_band")
)


# the column whose best cut lowers the variance most is the one that a single split uses
@query("a61_importance_by_gain", f"""with xy as materialized (select n_lines, floor(qty / 16) as qty_band, margin from {XY_SQL} where not {TEST}),
 gains as ({_GAINS})
 select feature, (gain = (select max(gain) from gains))::integer::double as importance from gains""")
def a61_by_gain(spark, sf_dir):
    xy = joined_xy(spark, sf_dir).withColumn("qty_band", F.floor(F.col("qty") / 16).cast("double"))
    train, _ = split.split_holdout(materialise(xy), None, split.BY_THRESHOLD)
    columns = ["n_lines", "qty_band"]
    pre = prep.fit_numeric_preprocessor(train, columns, prep.PreprocessConfig(scaling="none"))
    tree = model.build_estimators({"decision_tree_regressor": STUMP}, model.REGRESSORS)
    return model.feature_importance(model.fit_models(pre, tree, train, "margin")["decision_tree_regressor"], columns)


@query("a64_importance_of_unused_column", f"select 'qty' as feature, 0.0::double as importance_mean, 0.0::double as importance_std from {XY_SQL} where {TEST} limit 1")
def a64_unused(spark, sf_dir):
    fitted, _ = _stump(spark, sf_dir, "decision_tree_classifier", model.CLASSIFIERS, "faulty", STUMP)
    test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)[1]
    found = explain.permutation_importance(fitted, test, "faulty", ["n_lines", "qty"], n_repeats=3)
    return found.filter("feature = 'qty'").select("feature", "importance_mean", "importance_std")


@query("b62_regression_stump", _VALUE_STUMP)
def b62_stump(spark, sf_dir):
    scored = _stump(spark, sf_dir, "decision_tree_regressor", model.REGRESSORS, "margin", STUMP)[1]
    return rounded(scored, "prediction", digits=2)


@query("b62_forest_of_one_stump", _VALUE_STUMP)
def b62_forest_stump(spark, sf_dir):
    one = {"n_estimators": 1, "bootstrap": False, **STUMP}
    return rounded(_stump(spark, sf_dir, "random_forest_regressor", model.REGRESSORS, "margin", one)[1], "prediction", digits=2)


@query("b63_one_boosting_round", _VALUE_STUMP)
def b63_stump(spark, sf_dir):
    one = {"n_estimators": 1, **STUMP}
    return rounded(_stump(spark, sf_dir, "boosted_trees_regressor", model.REGRESSORS, "margin", one)[1], "prediction", digits=2)


@query("b57_svm_classifier")
def b57(spark, sf_dir):
    return _predictions(spark, sf_dir, "svm_classifier", {"kernel": "linear", "C": 1.0})


@query("b58_naive_bayes_classifier", _naive_bayes_sql())
def b58(spark, sf_dir):
    return _predictions(spark, sf_dir, "naive_bayes_classifier")


def _linear_sql() -> str:
    """Ordinary least squares on one scaled feature has a closed form."""
    return f"""with f as (select regr_slope(margin, price) as b, regr_intercept(margin, price) as a from {XY_SQL} where not {TEST})
 select id, margin, round(a + b * price, 2) as prediction from {XY_SQL}, f where {TEST}"""


@query("b60_linear_regression", _linear_sql())
def b60(spark, sf_dir):
    fitted, _, test = _price_model(spark, sf_dir)
    return rounded(model.predict(fitted, test, ["id", "margin"]), "prediction", digits=2)


@query("b60_ridge_and_lasso")
def b60_ridge(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, FEATURES)
    chosen = model.build_estimators({"ridge_regression": {"alpha": 1.0}, "lasso_regression": {"alpha": 0.1}}, model.REGRESSORS)
    scored = model.score_models(model.fit_models(pre, chosen, train, "margin"), test, "margin")
    return evaluate.rank_regressors(evaluate.regression_scores(scored, by=["model", "model_ordinal"]))


def _price_model(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, ["price"])
    chosen = model.build_estimators({"linear_regression": {}}, model.REGRESSORS)
    return model.fit_models(pre, chosen, train, "margin")["linear_regression"], train, test


@query("b60_ridge_and_lasso_one_feature", f"""with xy as materialized (select * from {XY_SQL}),
 s as (select avg(price) as m, stddev_pop(price) as sd, avg(margin) as y, covar_pop(price, margin) / stddev_pop(price) as c, count(*) as n from xy where not {TEST})
 select id, round(y + c * n / (n + 500) * (price - m) / sd, 2) as ridge,
 round(y + sign(c) * greatest(abs(c) - 300, 0) * (price - m) / sd, 2) as lasso from xy, s where {TEST}""")
def b60_one(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, ["price"])
    chosen = model.build_estimators({"ridge_regression": {"alpha": 500.0}, "lasso_regression": {"alpha": 300.0}}, model.REGRESSORS)
    fitted = model.fit_models(pre, chosen, train, "margin")
    ridge = model.predict(fitted["ridge_regression"], test, ["id", "price"]).withColumnRenamed("prediction", "ridge")
    both = model.predict(fitted["lasso_regression"], ridge, ["id", "ridge"]).withColumnRenamed("prediction", "lasso")
    return rounded(both, "ridge", "lasso", digits=2)


@query("b61_quadratic_one_feature", f"""with xy as materialized (select *, price * price as p2 from {XY_SQL}), tr as (select * from xy where not {TEST}),
 f as (select regr_slope(margin, price) as b, regr_intercept(margin, price) as a, regr_slope(p2, price) as d, regr_intercept(p2, price) as c from tr),
 g as (select regr_slope(margin, p2 - c - d * price) as q from tr, f)
 select id, round(a + b * price + q * (p2 - c - d * price), 1) as prediction from xy, f, g where {TEST}""")
def b61_one(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, ["price"])
    chosen = model.build_estimators({"polynomial_regression": {"degree": 2}}, model.REGRESSORS)
    fitted = model.fit_models(pre, chosen, train, "margin")["polynomial_regression"]
    return rounded(model.predict(fitted, test, ["id"]), "prediction", digits=1)


@query("b61_polynomial_regression")
def b61(spark, sf_dir):
    return _predictions(spark, sf_dir, "polynomial_regression", {"degree": 2}, model.REGRESSORS, "margin")


@query("b62_tree_regressors")
def b62(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, FEATURES)
    chosen = model.build_estimators({"decision_tree_regressor": {"max_depth": None},
                                     "random_forest_regressor": {"n_estimators": 200, "max_depth": 10}}, model.REGRESSORS)
    scored = model.score_models(model.fit_models(pre, chosen, train, "margin"), test, "margin")
    return evaluate.rank_regressors(evaluate.regression_scores(scored, by=["model", "model_ordinal"]))


@query("b63_boosted_trees")
def b63(spark, sf_dir):
    return _predictions(spark, sf_dir, "boosted_trees_regressor", {"n_estimators": 300, "max_depth": 6}, model.REGRESSORS, "margin")


def _vectors(spark, sf_dir, label):
    train, _ = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, FEATURES)
    return model.labelled(pre, train, label, ["id"])


def _training_rows(spark, sf_dir, x=None):
    xy = joined_xy(spark, sf_dir) if x is None else x.join(labels_y(spark, sf_dir), "id")
    return split.split_holdout(materialise(xy), None, split.BY_THRESHOLD)[0]


@query("b64_grid_search")
def b64(spark, sf_dir):
    grid = [("decision_tree_classifier", {"max_depth": d, "min_samples_leaf": n}) for d in (3, 5, 10, None) for n in (1, 5, 10)]
    return model.search_pipeline(_training_rows(spark, sf_dir), FEATURES, "faulty", grid)


FOLD = f"cast(('0x' || {digest_sql('id', 42, 13)})::bigint % 5 as integer)"
ALPHAS = [0.0, 0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]


def _fold_errors_sql(fill: str, tried: list[tuple[str, float]]) -> str:
    """One feature with missing values, filled and scaled per training part: ridge and lasso have closed forms."""
    values = ", ".join(f"({i}, '{kind}', {alpha!r}::double)" for i, (kind, alpha) in enumerate(tried))
    return f"""with xy as materialized (select x.id, x.qty, y.margin, fold from {X_MISSING_SQL} x join
   (select id, margin, {FOLD} as fold from {Y_SQL} where not {TEST}) y on x.id = y.id),
 m as (select k, {fill} as m from xy, range(5) r(k) where fold <> k group by k),
 z as materialized (select k, fold, margin, coalesce(qty, m) as z from xy, m),
 s as (select k, avg(z) as c, stddev_pop(z) as d, avg(margin) as y, covar_pop(z, margin) / stddev_pop(z) as g, count(*) as n from z where fold <> k group by k),
 p(candidate, model, alpha) as (values {values}),
 w as (select *, case when model = 'lasso_regression' then sign(g) * greatest(abs(g) - alpha, 0) else g * n / (n + alpha) end as w from s, p)
 select candidate::int as candidate, model, alpha, fold, round(sqrt(avg((margin - y - w * (z - c) / d) ** 2)), 2) as rmse, count(*) as support
 from w join z on w.k = z.k and z.fold = w.k group by 1, 2, 3, 4"""


LINEAR_GRIDS = {"linear_regression": [0.0], "ridge_regression": ALPHAS[1:], "lasso_regression": [0.001, 0.01, 0.1, 1.0, 1000.0]}
MANY = {"ridge_regression": [round(1.7**i, 6) for i in range(25)], "lasso_regression": [round(1.5**i, 6) for i in range(25)]}


def _linear_folds(spark, sf_dir, grids, fill, strategy="grid"):
    found = fold_sums.linear_search(_training_rows(spark, sf_dir, x_missing(spark, sf_dir)), ["qty"], "margin", grids,
                                    strategy=strategy, n_iter=30, cfg=prep.PreprocessConfig(fill))
    return rounded(found, "rmse", digits=2)


@query("b64_linear_grid_folds", _fold_errors_sql("avg(qty)", fold_sums.linear_candidates(LINEAR_GRIDS)))
def b64_linear(spark, sf_dir):
    return _linear_folds(spark, sf_dir, LINEAR_GRIDS, "mean")


@query("b65_linear_random_folds", _fold_errors_sql("median(qty)", fold_sums.chosen_candidates(fold_sums.linear_candidates(MANY), "random", 30, 42)))
def b65_linear(spark, sf_dir):
    return _linear_folds(spark, sf_dir, MANY, "median", "random")


@query("b65_random_search")
def b65(spark, sf_dir):
    return fold_sums.linear_search(_training_rows(spark, sf_dir, x_missing(spark, sf_dir)), FEATURES, "margin", MANY, "random", 30)


@query("b66_regressor_folds", _fold_errors_sql("avg(qty)", [("ridge_regression", 500.0)]))
def b66_ridge(spark, sf_dir):
    """The same by fitting every fold on its rows, as for models without merging sums."""
    rows = _training_rows(spark, sf_dir, x_missing(spark, sf_dir))
    found = model.search_pipeline(rows, ["qty"], "margin", [("ridge_regression", {"alpha": 500.0})], model.REGRESSORS,
                                  cfg=prep.PreprocessConfig("mean"))
    return rounded(found.select("candidate", "model", F.lit(500.0).alias("alpha"), "fold", "rmse", "support"), "rmse", digits=2)


SMOOTHINGS = [1e-9, 1e-8, 1e-3]


def _smoothing_sql() -> str:
    """Gaussian naive Bayes per fold, filled with the mean of the training part, for several smoothings."""
    fill = ", ".join(f"avg({c}) as a_{c}" for c in FEATURES)
    filled = ", ".join(f"coalesce({c}, a_{c}) as {c}" for c in FEATURES)
    fit = ", ".join(f"avg({c}) as m_{c}, var_pop({c}) as v_{c}" for c in FEATURES)
    largest = "greatest(" + ", ".join(f"var_pop({c})" for c in FEATURES) + ")"
    score = "ln(n / total)" + "".join(f" - 0.5 * ln(v_{c} + s * e) - ({c} - m_{c}) ** 2 / (2 * (v_{c} + s * e))" for c in FEATURES)
    scored = "select candidate || ':' || fold as model, faulty as label, prediction from scored"
    tried = ", ".join(f"({i}, {s!r}::double)" for i, s in enumerate(SMOOTHINGS))
    return f"""with xy as materialized (select x.*, y.faulty, fold from {X_MISSING_SQL} x join
   (select id, faulty, {FOLD} as fold from {Y_SQL} where not {TEST}) y on x.id = y.id),
 a as (select k, {fill} from xy, range(5) r(k) where fold <> k group by k),
 z as materialized (select k, id, fold, faulty, {filled} from xy, a),
 e as (select k, {largest} as e from z where fold <> k group by k),
 g as (select k, faulty as cls, count(*)::double as n, sum(count(*)) over (partition by k) as total, {fit} from z where fold <> k group by k, faulty),
 p(candidate, s) as (values {tried}),
 scored as materialized (select candidate, id, z.fold, z.faulty, arg_max(cls, {score}) as prediction from z join g on z.k = g.k and z.fold = z.k join e on e.k = z.k, p group by 1, 2, 3, 4)
 select split_part(model, ':', 1)::int as candidate, s as var_smoothing, split_part(model, ':', 2)::int as fold,
 round(sum(hits)::double / sum(support), 6) as accuracy, round(sum(f * support)::double / sum(support), 6) as f1_weighted, sum(support)::bigint as support
 from {scores_sql(scored)} t join p on p.candidate = split_part(t.model, ':', 1)::int group by 1, 2, 3"""


@query("b64_bayes_smoothing_folds", _smoothing_sql())
def b64_bayes(spark, sf_dir):
    rows = _training_rows(spark, sf_dir, x_missing(spark, sf_dir))
    found = bayes.bayes_search(rows, FEATURES, "faulty", SMOOTHINGS, cfg=prep.PreprocessConfig("mean", "none"))
    return rounded(found, "accuracy", "f1_weighted")


@query("b58_bayes_smoothed", _naive_bayes_sql("0.01 * greatest(" + ", ".join(f"var_pop({c}) over ()" for c in FEATURES) + ")"))
def b58_smoothed(spark, sf_dir):
    fitted, _, test = _fitted(spark, sf_dir, "naive_bayes_classifier", {"var_smoothing": 0.01}, scaling="none")
    return model.predict(fitted, test, ["id", "faulty"])


@query("b66_cross_validation")
def b66(spark, sf_dir):
    tree = model.build_estimators({"decision_tree_classifier": {"max_depth": 4}})["decision_tree_classifier"]
    return model.cross_validate(tree, _vectors(spark, sf_dir, "faulty"), folds=5)


def _bayes_folds_sql() -> str:
    fit = ", ".join(f"avg({c}) as m_{c}, var_pop({c}) as v_{c}" for c in FEATURES)
    score = "ln(n / total)" + "".join(f" - 0.5 * ln(v_{c}) - ({c} - m_{c}) ** 2 / (2 * v_{c})" for c in FEATURES)
    scored = "select fold::varchar as model, faulty as label, prediction from scored"
    return f"""with xy as materialized (select *, cast(('0x' || {digest_sql('id', 42, 13)})::bigint % 5 as integer) as fold from {XY_SQL} where not {TEST}),
 g as (select k, faulty as cls, count(*)::double as n, sum(count(*)) over (partition by k) as total, {fit} from xy, range(5) r(k) where fold <> k group by k, faulty),
 scored as materialized (select id, fold, faulty, arg_max(cls, {score}) as prediction from xy join g on k = fold group by 1, 2, 3)
 select model::integer as fold, round(sum(hits)::double / sum(support), 6) as accuracy, round(sum(f * support)::double / sum(support), 6) as f1_weighted,
 sum(support)::bigint as support from {scores_sql(scored)} group by model"""


@query("b66_cross_validation_bayes", _bayes_folds_sql())
def b66_bayes(spark, sf_dir):
    bayes = model.build_estimators({"naive_bayes_classifier": {}})["naive_bayes_classifier"]
    return rounded(model.cross_validate(bayes, _vectors(spark, sf_dir, "faulty"), folds=5), "accuracy", "f1_weighted")


@query("b66_fold_column", f"""select id, faulty, cast(('0x' || {digest_sql('id', 42, 13)})::bigint % 5 as integer) as fold from {Y_SQL}""")
def b66_folds(spark, sf_dir):
    return split.fold_column(labels_y(spark, sf_dir).drop("margin"), 5)


@query("b67_probabilistic_regression")
def b67(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, FEATURES)
    linear = model.build_estimators({"linear_regression": {}}, model.REGRESSORS)["linear_regression"]
    return model.fit_probabilistic_regression(pre, linear, train, "margin").transform(test, ["id", "margin"])


PRICE_FIT = f"(select regr_slope(margin, price) as b, regr_intercept(margin, price) as a from {XY_SQL} where not {TEST})"


@query("b67_probabilistic_one_feature", f"""with f as {PRICE_FIT},
 r as (select price, abs(margin - a - b * price) as miss from {XY_SQL}, f where not {TEST}),
 g as (select regr_slope(miss, price) as d, regr_intercept(miss, price) as c, avg(miss) as typical from r)
 select id, 'norm' as distribution, round(a + b * price, 2) as loc,
 round(greatest((c + d * price) * sqrt(pi() / 2), typical / 1000), 2) as scale from {XY_SQL}, f, g where {TEST}""")
def b67_one(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    pre = prep.fit_numeric_preprocessor(train, ["price"])
    linear = model.build_estimators({"linear_regression": {}}, model.REGRESSORS)["linear_regression"]
    fitted = model.fit_probabilistic_regression(pre, linear, train, "margin")
    return rounded(fitted.transform(test, ["id"]), "loc", "scale", digits=2)


@query("b69_coefficient_one_feature", f"""select 'price' as feature, round(b * s, 3) as coefficient, round(abs(b * s), 3) as magnitude
 from {PRICE_FIT}, (select stddev_pop(price) as s from {XY_SQL} where not {TEST})""")
def b69_one(spark, sf_dir):
    fitted, _, _ = _price_model(spark, sf_dir)
    return rounded(model.coefficients(fitted, ["price"]), "coefficient", "magnitude", digits=3)


@query("b70_partial_dependence_line", f"""with f as {PRICE_FIT},
 e as (select quantile_cont(price, 0.05) as lo, quantile_cont(price, 0.95) as hi, count(*) as n from {XY_SQL} where {TEST})
 select 'price' as feature, round(lo + (hi - lo) * i / 49, 2) as grid_value, round(a + b * (lo + (hi - lo) * i / 49), 2) as mean_prediction, n
 from f, e, range(50) r(i)""")
def b70_line(spark, sf_dir):
    fitted, _, test = _price_model(spark, sf_dir)
    return rounded(explain.partial_dependence(fitted, test, ["price"]), "grid_value", "mean_prediction", digits=2)


@query("b76_batch_scoring_line", f"""select id, round(a + b * price, 2) as prediction from {X_SQL}, {PRICE_FIT}""")
def b76_line(spark, sf_dir):
    fitted, _, _ = _price_model(spark, sf_dir)
    return rounded(model.batch_scoring(fitted, features_x(spark, sf_dir)), "prediction", digits=2)


@query("a64_shuffle_is_permutation", f"""select r.i::integer as repeat, count(*) as n_rows, round(sum(price), 0) as price_total, round(min(price), 2) as price_min,
 round(max(price), 2) as price_max, 0 as unmoved from {XY_SQL}, range(3) r(i) group by 1""")
def a64_shuffle(spark, sf_dir):
    xy = joined_xy(spark, sf_dir)
    copies = explain.shuffled_copies(xy, FEATURES, 3, 42, ["id"])
    price = F.col("partner.price")
    same = F.col("partner") == F.col("own")
    return copies.groupBy("repeat").agg(
        F.count("*").alias("n_rows"), F.round(F.sum(price), 0).alias("price_total"), F.round(F.min(price), 2).alias("price_min"),
        F.round(F.max(price), 2).alias("price_max"), F.count_if(same).cast("int").alias("unmoved"))


@query("b69_coefficients")
def b69(spark, sf_dir):
    fitted, _, _ = _fitted(spark, sf_dir, "linear_regression", {}, model.REGRESSORS, "margin")
    return model.coefficients(fitted, FEATURES)


@query("b70_partial_dependence")
def b70(spark, sf_dir):
    fitted, _, test = _fitted(spark, sf_dir, "decision_tree_classifier", TREES["decision_tree_classifier"])
    return explain.partial_dependence(fitted, test, FEATURES)


@query("b76_batch_scoring")
def b76(spark, sf_dir):
    fitted, _, _ = _fitted(spark, sf_dir, "decision_tree_classifier", TREES["decision_tree_classifier"])
    return model.batch_scoring(fitted, features_x(spark, sf_dir))
