"""Scores from confusion counts. The data is read once; everything else works on K*K rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns, zero_safe_ratio
from sensorlens.functions.frames import report_frame

NORMALISATIONS = ("true", "pred", "all", None)


def confusion_counts(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (label, prediction), counted inside each partition before the exchange.

    Whole numbers come out as int, whatever type they had; texts and fractions stay as they are.
    """
    require_columns(scored, [label, prediction, *by])
    a, b = _classes(scored, label, prediction)
    return scored.groupBy(*[quoted(c) for c in by], a.alias("label"), b.alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _classes(scored: DataFrame, label: str, prediction: str) -> tuple[Column, Column]:
    kinds = [scored.schema[c].dataType.typeName() for c in (label, prediction)]
    if "string" in kinds:
        return quoted(label).cast("string"), quoted(prediction).cast("string")
    return quoted(label).cast("int"), quoted(prediction).cast("int")


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 per class; 0 where a denominator is 0."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("support"),
                    none.alias("predicted"),
                    hit.cast("long").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    none.alias("support"),
                    F.col("n").alias("predicted"),
                    none.alias("hits"),
                ),
            )
        ),
    )
    totals = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    hits = F.col("hits").cast("double")
    return totals.select(
        *by,
        "class",
        "support",
        "hits",
        zero_safe_ratio(hits, F.col("predicted").cast("double")).alias("precision"),
        zero_safe_ratio(hits, F.col("support").cast("double")).alias("recall"),
        zero_safe_ratio(hits * 2, (F.col("predicted") + F.col("support")).cast("double")).alias("f1"),
    )


def _weighted(score: str) -> Column:
    return zero_safe_ratio(
        F.sum(F.col(score) * F.col("support")), F.sum("support").cast("double")
    )


def headline_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted and macro F1 of each group of confusion counts."""
    return (
        class_scores(counts, by)
        .groupBy(*by)
        .agg(
            zero_safe_ratio(F.sum("hits").cast("double"), F.sum("support").cast("double")).alias(
                "accuracy"
            ),
            _weighted("f1").alias("f1_weighted"),
            F.avg("f1").alias("f1_macro"),
            F.sum("support").alias("support"),
        )
    )


def classification_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    return report_of_counts(confusion_counts(scored, label, prediction, by), by)


def report_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The classification report of confusion counts."""
    scores = class_scores(counts, by)
    parts = ("precision", "recall", "f1")
    gathered = scores.groupBy(*by).agg(
        F.collect_list(
            F.struct(
                F.col("class").cast("string").alias("class"),
                *parts,
                F.col("support").cast("long").alias("support"),
            )
        ).alias("rows"),
        F.sum("support").alias("all_rows"),
        zero_safe_ratio(F.sum("hits").cast("double"), F.sum("support").cast("double")).alias("acc"),
        *[F.avg(p).alias(f"macro_{p}") for p in parts],
        *[_weighted(p).alias(f"weighted_{p}") for p in parts],
    )

    def summary(name: str, columns: Mapping[str, str]) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[F.col(columns[p]).alias(p) for p in parts],
            F.col("all_rows").cast("long").alias("support"),
        )

    extra = F.array(
        summary("accuracy", dict.fromkeys(parts, "acc")),
        summary("macro avg", {p: f"macro_{p}" for p in parts}),
        summary("weighted avg", {p: f"weighted_{p}" for p in parts}),
    )
    return gathered.select(*by, F.inline(F.concat("rows", extra)))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction", by=()):
    return headline_scores(confusion_counts(scored, label, prediction, by), by).select(
        *by, "accuracy"
    )


def f1_weighted(scored: DataFrame, label: str = "label", prediction: str = "prediction", by=()):
    return headline_scores(confusion_counts(scored, label, prediction, by), by).select(
        *by, "f1_weighted"
    )


def confusion_matrix(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    normalize: str | None = "true",
) -> DataFrame:
    """Confusion counts with a share of the true class, the predicted class or all rows."""
    return matrix_of_counts(confusion_counts(scored, label, prediction), normalize)


def matrix_of_counts(counts: DataFrame, normalize: str | None = "true") -> DataFrame:
    """The confusion matrix of counts."""
    if normalize not in NORMALISATIONS:
        raise ValueError(f"normalize must be one of {NORMALISATIONS}, got {normalize!r}")
    if normalize is None:
        return counts.withColumn("share", F.col("n").cast("double"))
    side = {"true": ["label"], "pred": ["prediction"], "all": []}[normalize]
    total = F.sum("n").over(W.partitionBy(*side))
    return counts.withColumn("share", zero_safe_ratio(F.col("n").cast("double"), total))


def compare_models(metrics: DataFrame, rank_by: Sequence[str] = ("f1_weighted", "accuracy")):
    """Models in rank order, best first; equal models keep the order they were listed in."""
    order = W.orderBy(*[F.desc(m) for m in rank_by], "model_ordinal")
    return metrics.withColumn("rank", F.row_number().over(order))


def best_model(metrics: DataFrame, metric: str = "f1_weighted") -> DataFrame:
    return metrics.orderBy(F.desc(metric), "model_ordinal").limit(1)


def top_k(importances: DataFrame, k: int = 30, score: str = "importance") -> DataFrame:
    return importances.orderBy(F.desc(score), "feature").limit(k)


def regression_scores(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Root mean squared and mean absolute error of rows that have label and prediction."""
    miss = quoted(prediction).cast("double") - quoted(label).cast("double")
    return scored.groupBy(*[quoted(c) for c in by]).agg(
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        F.count(miss).alias("support"),
    )


def rank_regressors(metrics: DataFrame) -> DataFrame:
    """Lowest RMSE first, MAE decides between equals."""
    order = W.orderBy("rmse", "mae", "model_ordinal")
    return metrics.withColumn("rank", F.row_number().over(order))


def baseline_prediction(
    train: DataFrame, test: DataFrame, label: str, baseline: str = "majority_class"
) -> DataFrame:
    """``test`` with the constant prediction a trivial model would give.

    majority_class: the most frequent training label (smallest among equals);
    naive_mean: the mean training label.
    """
    if baseline == "majority_class":
        counts = train.filter(quoted(label).isNotNull()).groupBy(quoted(label).alias("v")).count()
        value = counts.agg(
            F.min(F.struct((-F.col("count")).alias("minus_n"), "v")).alias("m")
        ).first()[0]["v"]
    elif baseline == "naive_mean":
        value = train.agg(F.avg(quoted(label))).first()[0]
    else:
        raise ValueError(f"baseline must be majority_class or naive_mean, got {baseline}")
    return test.withColumn("prediction", F.lit(value).cast("double"))


def business_kpis(counts: DataFrame, kpis: Mapping[str, str]) -> DataFrame:
    """Named SQL aggregates over confusion counts (columns label, prediction, n)."""
    return counts.agg(*[F.expr(rule).cast("double").alias(name) for name, rule in kpis.items()])


def go_no_go(
    metrics: DataFrame, min_accuracy: float = 0.70, min_f1_weighted: float = 0.65
) -> DataFrame:
    ok = (F.col("accuracy") >= min_accuracy) & (F.col("f1_weighted") >= min_f1_weighted)
    return metrics.withColumn("go", F.coalesce(ok, F.lit(False)))


def leakage_detection(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str = "id",
    time_col: str | None = None,
) -> DataFrame:
    """Checks for information that reached the training side, one row per check.

    target_in_features counts label columns among the features, train_test_overlap counts
    keys on both sides (keys are reduced per side first, so the join is one row per key),
    time_leakage counts training rows at or after the first test time.
    """
    from sensorlens.operators.split import micros

    require_columns(train, [*features, label, key])
    sides = train.select(quoted(key).alias("k"), F.lit(1).alias("tr"), F.lit(0).alias("te"))
    sides = sides.unionByName(
        test.select(quoted(key).alias("k"), F.lit(0).alias("tr"), F.lit(1).alias("te"))
    )
    per_key = sides.groupBy("k").agg(F.max("tr").alias("tr"), F.max("te").alias("te"))
    overlap = per_key.agg(F.count_if((F.col("tr") == 1) & (F.col("te") == 1)))
    rows = [
        ("target_in_features", sum(f == label for f in features)),
        ("train_test_overlap", overlap.first()[0]),
    ]
    if time_col is not None:
        first = test.agg(F.min(micros(test, time_col))).first()[0]
        late = F.lit(False) if first is None else micros(train, time_col) >= F.lit(first)
        rows.append(("time_leakage", train.agg(F.count_if(late)).first()[0]))
    return report_frame(
        train.sparkSession,
        [(name, n, n == 0) for name, n in rows],
        "check string, findings long, passed boolean",
    )


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free digest of all values, to compare two runs."""
    h = F.xxhash64(*[quoted(c) for c in df.columns])
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"),
    )


def reproducibility_check(first: DataFrame, second: DataFrame) -> DataFrame:
    """Do two runs hold the same rows, regardless of order."""
    a, b = content_fingerprint(first).first(), content_fingerprint(second).first()
    row = (a["n_rows"], b["n_rows"], first.columns == second.columns and a == b)
    return report_frame(
        first.sparkSession, [row], "rows_first long, rows_second long, identical boolean"
    )
