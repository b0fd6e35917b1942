"""Model-agnostic explanation of a fitted model on hold-out rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import quoted, require_columns, split_number
from sensorlens.functions.frames import materialise, report_frame, union_all
from sensorlens.operators.evaluate import confusion_counts, headline_scores, regression_scores, top_k
from sensorlens.operators.order_stats import quantiles, smallest_rows

SHUFFLE_GROUP_ROWS = 10_000


def sample_for_explaining(df: DataFrame, sample_rows: int | None, key: str, seed: int) -> DataFrame:
    """``sample_rows`` rows with the smallest key hash; all rows when ``None``."""
    if sample_rows is None:
        return df
    return smallest_rows(df, sample_rows, split_number(quoted(key), seed))


def shuffled_copies(
    rows: DataFrame,
    features: Sequence[str],
    n_repeats: int,
    random_state: int,
    keep: Sequence[str] = (),
    group_rows: int = SHUFFLE_GROUP_ROWS,
) -> DataFrame:
    """Each row once per repeat with a random partner's features in ``partner``.

    The rows are written down once with a row number. Per repeat a hash of the row number
    scatters them over groups of about ``group_rows`` rows, and within a group, in the order
    of a second hash, every row takes the features of the next one (the last takes those of
    the first). That is a random permutation of the column without ranking all rows, and no
    group grows with the data. Equal keys or equal rows do not matter: the hash is taken of
    the row number.
    """
    own = F.struct(*[quoted(c) for c in features])
    written = materialise(
        rows.select(
            *[quoted(c) for c in keep],
            own.alias("own"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    groups = max(1, -(-written.count() // group_rows))
    repeated = written.withColumn(
        "repeat", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1)))
    ).withColumns(
        {
            "_group": F.pmod(
                F.xxhash64("_row", "repeat", F.lit(random_state)), F.lit(groups)
            ),
            "_order": F.xxhash64(F.lit(random_state), "repeat", "_row", F.lit("order")),
        }
    )
    in_group = W.partitionBy("repeat", "_group").orderBy("_order", "_row")
    up_to_here = in_group.rowsBetween(W.unboundedPreceding, W.currentRow)
    partner = F.coalesce(F.lead("own").over(in_group), F.first("own").over(up_to_here))
    return repeated.withColumn("partner", partner).drop("_group", "_order", "_row")


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    label: str,
    features: Sequence[str],
    n_repeats: int = 10,
    random_state: int = 42,
    k: int = 30,
    scoring: str = "f1_weighted",
    key: str = "id",
    sample_rows: int | None = None,
) -> DataFrame:
    """Loss of score after shuffling one feature at a time, mean over the repeats.

    All repeats and features are scored in one job: every shuffled row is expanded into
    one copy per feature with that feature swapped, and the copies are counted per
    (feature, repeat, label, prediction) before they are exchanged.
    """
    require_columns(df, [label, *features])
    rows = sample_for_explaining(df, sample_rows, key, random_state)
    score = _scorer(scoring)
    base = score(model.transform(rows).select(quoted(label).alias("label"), "prediction"), [])
    base_value = base.first()["score"]
    copies = shuffled_copies(
        rows.withColumnRenamed(label, "_label"), features, n_repeats, random_state, ["_label"]
    )
    swaps = [
        F.struct(
            F.lit(f).alias("feature"),
            *[F.col("partner" if g == f else "own").getField(g).alias(g) for g in features],
        )
        for f in features
    ]
    expanded = copies.select("_label", "repeat", F.inline(F.array(*swaps)))
    scored = model.transform(expanded).select(
        "feature", "repeat", F.col("_label").alias("label"), "prediction"
    )
    per_repeat = score(scored, ["feature", "repeat"])
    means = per_repeat.groupBy("feature").agg(
        (F.lit(base_value) - F.avg("score")).alias("importance_mean"),
        F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("importance_std"),
    )
    return top_k(means, k, "importance_mean")


def _scorer(scoring: str):
    if scoring in ("f1_weighted", "accuracy"):

        def classify(scored: DataFrame, by: list[str]) -> DataFrame:
            heads = headline_scores(confusion_counts(scored, by=by), by)
            return heads.select(*by, F.col(scoring).alias("score"))

        return classify
    if scoring == "neg_root_mean_squared_error":

        def regress(scored: DataFrame, by: list[str]) -> DataFrame:
            return regression_scores(scored, by=by).select(*by, (-F.col("rmse")).alias("score"))

        return regress
    raise ValueError(f"unknown scoring {scoring}")


def partial_dependence(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    grid_resolution: int = 50,
    max_features: int | None = None,
    key: str = "id",
    sample_rows: int | None = None,
    random_state: int = 42,
) -> DataFrame:
    """Mean prediction with one feature held at each grid value.

    The grid runs over evenly spaced values between the 5th and 95th percentile. Each row is
    expanded by the grids of all features inside its task, scored, and averaged there before
    the exchange: one scan for all features.
    """
    chosen = list(features)[:max_features]
    rows = sample_for_explaining(df, sample_rows, key, random_state)
    ends = quantiles(df, chosen, (0.05, 0.95))
    steps = max(1, grid_resolution - 1)
    held = []
    for f in chosen:
        lo, hi = ends[f]
        if lo is not None:
            points = sorted({lo + (hi - lo) * i / steps for i in range(grid_resolution)})
            held += [F.struct(F.lit(f).alias("feature"), F.lit(float(p)).alias("value")) for p in points]
    if not held:
        return report_frame(
            df.sparkSession,
            [],
            "feature string, grid_value double, mean_prediction double, n long",
        )
    spread = rows.select(*[quoted(c) for c in features], F.explode(F.array(*held)).alias("_held"))
    feature, value = F.col("_held.feature"), F.col("_held.value")
    fixed = spread.withColumns(
        {c: F.when(feature == c, value).otherwise(quoted(c).cast("double")) for c in features}
    )
    return (
        model.transform(fixed)
        .groupBy(feature.alias("feature"), value.alias("grid_value"))
        .agg(F.avg("prediction").alias("mean_prediction"), F.count("*").alias("n"))
    )
