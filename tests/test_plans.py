"""Shape of the physical plans: what is read, what is exchanged, what never appears."""

import re

import pytest
from pyspark.sql import functions as F

from sensorlens.operators import evaluate, keys, prep, profile, select, split
from sensorlens.plans.tables import features_x, labels_y, rule_scored, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def test_profile_reads_only_its_columns_and_ships_partial_rows(spark, sf_dir):
    text = plan(profile.column_stats(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax"]))
    assert scans(text) == [{"l_quantity", "l_tax"}]
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_default_split_is_a_filter(spark, sf_dir):
    train, test = split.split_holdout(labels_y(spark, sf_dir), "faulty")
    assert "Exchange" not in plan(train) and "Exchange" not in plan(test)


def test_exact_split_is_a_filter_too(spark, sf_dir):
    train, _ = split.split_holdout(labels_y(spark, sf_dir), "faulty", split.HoldoutConfig(exact=True))
    assert "Exchange" not in plan(train)


def test_fitted_transforms_do_not_shuffle(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pre = prep.fit_numeric_preprocessor(lines, ["l_quantity", "l_tax"])
    text = plan(pre.transform(lines))
    assert "Exchange" not in text and scans(text) == [{"l_quantity", "l_tax"}]


def test_histogram_counts_before_the_exchange(spark, sf_dir):
    text = plan(profile.histograms(table(spark, sf_dir, "lineitem"), cols=["l_tax"]))
    assert "partial_count" in text and scans(text) == [{"l_tax"}]


def test_time_filter_reaches_the_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = plan(select.time_window_selection(events, "ts", "2024-01-03 00:00:00", "2024-01-05 00:00:00").select("event_id"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert scans(text) == [{"event_id", "ts"}]


def test_confusion_counts_ship_only_classes(spark, sf_dir):
    text = plan(evaluate.classification_report(rule_scored(spark, sf_dir)))
    assert "partial_count" in text and not any(w in text for w in FORBIDDEN)


def test_key_overlap_needs_no_join(spark, sf_dir):
    text = plan(keys.key_overlap(features_x(spark, sf_dir), labels_y(spark, sf_dir), "id"))
    assert "Join" not in text and "Window" not in text


def test_no_whole_table_in_one_task(spark, sf_dir):
    """Single-partition exchanges carry aggregates only: something partial lies right below."""
    lines = table(spark, sf_dir, "lineitem")
    for df in (
        profile.null_count(lines),
        profile.min_max_mean_std(lines, ["l_tax"]),
        profile.cardinality_count(lines, cols=["l_partkey", "l_tax"]),
        profile.duplicate_detection(lines, ["l_orderkey", "l_linenumber"]),
        keys.duplicate_key_count(lines, "l_orderkey"),
        profile.correlation_matrix(lines, cols=["l_tax", "l_discount"]),
    ):
        lines_of_plan = plan(df).splitlines()
        for i, line in enumerate(lines_of_plan):
            if "Exchange SinglePartition" in line:
                assert "partial_" in lines_of_plan[i + 1], "\n".join(lines_of_plan[i : i + 3])


@pytest.mark.parametrize("name", ["a19_inner_join_x_y", "a30_histograms", "b02_outliers_iqr", "b43_aggregations", "b51_priority_rules"])
def test_queries_stay_in_the_jvm_and_join_by_key(spark, sf_dir, name):
    from sensorlens.plans import all_queries

    text = plan(all_queries()[name](spark, sf_dir))
    assert not any(w in text for w in FORBIDDEN)


def test_join_of_features_prunes_columns(spark, sf_dir):
    joined = keys.inner_join_x_y(features_x(spark, sf_dir), labels_y(spark, sf_dir), "id").select("id", "qty", "faulty")
    assert {"l_extendedprice", "l_tax", "o_totalprice"}.isdisjoint(set().union(*scans(plan(joined))))
    assert joined.agg(F.count("*")).first()[0] > 0
