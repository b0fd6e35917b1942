"""Writing reports, metrics, predictions and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted
from sensorlens.operators.profile import row_cap

FORMATS = ("json", "parquet", "csv")


def metrics_document(report: DataFrame, best: str) -> DataFrame:
    """Nest a per-model classification report into one document row.

    ``report`` has columns model, class, precision, recall, f1, support, as
    :func:`sensorlens.operators.evaluate.classification_report` gives them. Its size is models
    times classes.
    """
    entry = F.struct(
        F.col("precision"),
        F.col("recall"),
        F.col("f1").alias("f1-score"),
        F.col("support").cast("double").alias("support"),
    )
    per_model = report.groupBy("model").agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("f1"))).alias("f1_weighted"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("class") != "accuracy", F.struct("class", entry.alias("v"))))
        ).alias("classification_report"),
    )
    models = F.map_from_entries(
        F.collect_list(
            F.struct("model", F.struct("accuracy", "f1_weighted", "classification_report"))
        )
    )
    return per_model.agg(models.alias("results")).select(F.lit(best).alias("best_model"), "results")


def interpretation_document(importance: DataFrame | None, permutation: DataFrame) -> DataFrame:
    """One document row with both ranked importance lists (at most top_k entries each)."""

    def ranked(table: DataFrame, score: str, name: str) -> DataFrame:
        pairs = F.collect_list(F.struct((-F.col(score)).alias("by"), "feature", score))
        ordered = F.transform(
            F.sort_array(pairs), lambda e: F.struct(e["feature"].alias("feature"), e[score].alias(score))
        )
        return table.agg(ordered.alias(name)).withColumn("doc", F.lit(1))

    right = ranked(permutation, "importance_mean", "permutation_importance")
    if importance is None:
        return right.select(F.array().alias("feature_importance"), "permutation_importance")
    left = ranked(importance, "importance", "feature_importance")
    return left.join(right, "doc").select("feature_importance", "permutation_importance")


def write_document(document: DataFrame, path: str) -> None:
    """A small nested document as one JSON part file."""
    document.coalesce(1).write.mode("overwrite").json(path)


def write_report(
    report: DataFrame,
    path: str,
    max_rows: int | None = None,
    order_by: Sequence[str] = ("ordinal",),
    format: str = "parquet",
) -> None:
    """A report table in report order; ``max_rows`` cuts it and marks whether rows are missing."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {format}")
    if max_rows is not None:
        report = row_cap(report, max_rows, order_by)
    ordered = report.orderBy(*[quoted(c) for c in order_by])
    writer = ordered.coalesce(1).write.mode("overwrite")
    if format == "csv":
        writer = writer.option("header", "true")
    writer.format(format).save(path)


def write_predictions(scored: DataFrame, path: str, key: str = "id") -> None:
    """(key, prediction) as line-delimited JSON, one file per partition."""
    scored.select(quoted(key), "prediction").write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
