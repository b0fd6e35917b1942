import pytest
from pyspark.sql import functions as F

from sensorlens.operators import split


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(2_000).withColumn("y", (F.pmod("id", F.lit(3)) == 0).cast("int"))


def test_disjoint_complete_and_repeatable(labelled):
    train, test = split.split_holdout(labelled, "y")
    again = split.split_holdout(labelled.repartition(13), "y")[1]
    train_ids, test_ids = ({r.id for r in d.collect()} for d in (train, test))
    assert not train_ids & test_ids and len(train_ids | test_ids) == 2_000
    assert test_ids == {r.id for r in again.collect()}
    assert len(test_ids) == 400


def test_seeds_are_independent(labelled):
    sets = []
    for seed in (42, 7):
        cfg = split.HoldoutConfig(random_state=seed)
        sets.append({r.id for r in split.split_holdout(labelled, "y", cfg)[1].collect()})
    assert 40 < len(sets[0] & sets[1]) < 130  # 4 % of 2000 is 80


@pytest.mark.parametrize("bound", [50, 1_000_000])
def test_exact_class_counts(labelled, bound, monkeypatch):
    real = split.order_statistics
    monkeypatch.setattr(split, "order_statistics", lambda *a, **k: real(*a, **k, bound=bound))
    cfg = split.HoldoutConfig(exact=True)
    counts = {r.y: r["count"] for r in split.split_holdout(labelled, "y", cfg)[1].groupBy("y").count().collect()}
    assert counts == {0: 267, 1: 133}  # 1333 and 667 rows: training takes 1066.4 and 533.6


def test_exact_plain_count(labelled):
    cfg = split.HoldoutConfig(test_size=0.301, stratify=False, exact=True)
    assert split.split_holdout(labelled, None, cfg)[1].count() == 602


def test_rows_of_one_key_stay_together(spark):
    df = spark.range(300).select(F.pmod("id", F.lit(30)).alias("id"), F.lit(1).alias("y"))
    train, test = split.split_holdout(df, "y")
    assert train.join(test, "id", "left_semi").count() == 0


def test_bad_arguments(labelled):
    with pytest.raises(KeyError):
        split.split_holdout(labelled, "absent")
    with pytest.raises(ValueError):
        split.split_holdout(labelled, "y", split.HoldoutConfig(test_size=1.0))
    with pytest.raises(ValueError):
        split.train_val_test(labelled, 0.6, 0.6)


def test_largest_remainder():
    assert split.largest_remainder({"a": 5, "b": 3, "c": 2}, 7) == {"a": 4, "b": 2, "c": 1}


def test_three_parts_and_folds(labelled):
    parts = {r.part: r["count"] for r in split.train_val_test(labelled).groupBy("part").count().collect()}
    assert set(parts) == {"train", "val", "test"} and sum(parts.values()) == 2_000
    folds = split.fold_column(labelled, 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(300 < r["count"] < 500 for r in folds)


def test_time_splits(spark):
    df = spark.range(100).withColumn("ts", F.timestamp_seconds(F.col("id") * 60))
    late = split.temporal_split(df, "ts", 0.2).filter("is_test")
    assert (late.count(), late.agg(F.min("id")).first()[0]) == (20, 80)
    folds = split.walk_forward_folds(df, "ts", 4)
    for k, (train, test) in enumerate(folds, start=1):
        assert (train.count(), test.count()) == (20 * k, 20)
        assert train.agg(F.max("id")).first()[0] < test.agg(F.min("id")).first()[0]


def test_a_rare_class_has_its_share_for_every_seed(spark):
    df = spark.range(2_000).withColumn("y", F.when(F.col("id") % 400 == 0, "rare").otherwise("common"))
    for seed in range(4):
        parts = split.train_val_test(df, 0.2, 0.2, seed, label="y")
        assert {r.part: r["count"] for r in parts.filter("y = 'rare'").groupBy("part").count().collect()} == {
            "train": 3, "val": 1, "test": 1
        }
        tested = split.split_holdout(df, "y", split.HoldoutConfig(random_state=seed))[1]
        assert tested.filter("y = 'rare'").count() == 1


def test_more_classes_than_a_filter_lists(labelled, monkeypatch):
    df = labelled.withColumn("c", F.when(F.col("id") % 50 != 0, F.col("id") % 50))
    listed = {r.id: r.is_test for r in split.holdout_side(df, "c").collect()}
    monkeypatch.setattr(split, "LISTED_CLASSES", 10)
    assert {r.id: r.is_test for r in split.holdout_side(df, "c").collect()} == listed
    train, test = split.split_holdout(df, "c")
    assert (train.count(), test.count()) == (1_600, 400)
