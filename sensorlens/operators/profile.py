"""Column profiling: everything the understanding step reports, one row per column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlens.functions.columns import numeric_cols, quoted, require_columns, split_number
from sensorlens.functions.frames import long_report, report_frame, union_all
from sensorlens.operators.order_stats import quantiles, smallest_rows

DISTINCT_COLUMNS_PER_SCAN = 16
# The percentiles reported by default.
DEFAULT_PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999)


def _columns(df: DataFrame, cols: Iterable[str] | None) -> list[str]:
    if cols is None:
        return list(df.columns)
    cols = list(cols)
    require_columns(df, cols)
    return cols


def _numeric(
    df: DataFrame, cols: Iterable[str] | None, exclude: Iterable[str], limit: int | None = None
) -> list[str]:
    chosen = numeric_cols(df, exclude) if cols is None else _columns(df, cols)
    return chosen if limit is None else chosen[:limit]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def split_sizes(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and share of the total per named frame; the share is a percentage."""
    counts = union_all(
        [
            df.agg(F.count("*").alias("n_rows")).select(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("split"),
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
            )
            for i, (name, df) in enumerate(parts.items())
        ]
    )
    gathered = counts.agg(
        F.sum("n_rows").alias("total"),
        F.collect_list(F.struct("ordinal", "split", "n_rows", "n_columns")).alias("parts"),
    )
    return gathered.select("total", F.inline("parts")).select(
        "ordinal",
        "split",
        "n_rows",
        "n_columns",
        F.round(F.try_divide(F.col("n_rows") * 100.0, F.col("total")), 2).alias("percentage"),
    )


def column_stats(df: DataFrame, cols: Iterable[str] | None = None, exclude=()) -> DataFrame:
    """Count, missing, range and moments of the numeric columns, all from one aggregate."""
    cols = _numeric(df, cols, exclude)
    aggs: list[Column] = [F.count("*").alias("rows")]
    for i, c in enumerate(cols):
        v = quoted(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
        ]
    rows = []
    for i, c in enumerate(cols):
        missing = F.col("rows") - F.col(f"n{i}")
        rows.append(
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                "n": F.col(f"n{i}"),
                "missing": missing,
                "missing_ratio": F.round(F.try_divide(missing, F.col("rows")), 6),
                "min": F.col(f"lo{i}"),
                "max": F.col(f"hi{i}"),
                "mean": F.col(f"mean{i}"),
                "std": F.col(f"std{i}"),
            }
        )
    return long_report(df.agg(*aggs), rows)


def min_max_mean_std(
    df: DataFrame, cols: Iterable[str] | None = None, exclude: Iterable[str] = ("id",)
) -> DataFrame:
    return column_stats(df, cols, exclude).select("column", "ordinal", "min", "max", "mean", "std")


def null_count(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Missing count and ratio of every column, whatever its type."""
    cols = _columns(df, cols)
    aggs = [F.count("*").alias("rows")]
    aggs += [F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(cols)]
    rows = []
    for i, c in enumerate(cols):
        missing = F.col("rows") - F.col(f"n{i}")
        rows.append(
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                "missing_count": missing,
                "missing_ratio": F.round(F.try_divide(missing, F.col("rows")), 6),
            }
        )
    return long_report(df.agg(*aggs), rows).orderBy(F.desc("missing_ratio"), "ordinal")


def missing_analysis(df: DataFrame, show_top_columns: int = 30) -> DataFrame:
    return null_count(df).limit(show_top_columns)


def dtype_analysis(df: DataFrame) -> DataFrame:
    """Type of each column beside the values it holds."""
    types = dict(df.dtypes)
    one = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return long_report(
        one,
        [
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                "dtype": F.lit(types[c]),
                "non_missing": F.col(f"n{i}"),
            }
            for i, c in enumerate(df.columns)
        ],
    )


def cardinality_count(
    df: DataFrame,
    max_unique_to_report: int | None = None,
    cols: Iterable[str] | None = None,
    approx: bool = False,
) -> DataFrame:
    """Distinct values per column, a missing value counting as one, largest first.

    Several exact distinct counts in one aggregate multiply the rows by the number of
    columns, so wide tables are read in column batches. ``approx=True`` needs one pass
    and no shuffle of values.
    """
    cols = _columns(df, cols)
    step = max(1, len(cols)) if approx else DISTINCT_COLUMNS_PER_SCAN
    counter = F.approx_count_distinct if approx else F.count_distinct
    parts = []
    for start in range(0, len(cols), step):
        batch = list(enumerate(cols))[start : start + step]
        one = df.agg(
            *[counter(quoted(c)).alias(f"u{i}") for i, c in batch],
            *[
                F.coalesce(F.max(quoted(c).isNull().cast("int")), F.lit(0)).alias(f"m{i}")
                for i, c in batch
            ],
        )
        parts.append(
            long_report(
                one,
                [
                    {
                        "column": F.lit(c),
                        "ordinal": F.lit(i),
                        "unique": F.col(f"u{i}") + F.col(f"m{i}"),
                    }
                    for i, c in batch
                ],
            )
        )
    ranked = union_all(parts).orderBy(F.desc("unique"), "ordinal")
    return ranked if max_unique_to_report is None else ranked.limit(max_unique_to_report)


def percentile_name(p: float) -> str:
    """``p`` and the percentage with all its digits, without trailing zeros: p5, p99.9, p99.95."""
    percent = f"{100 * Decimal(repr(float(p))):f}"
    return "p" + (percent.rstrip("0").rstrip(".") if "." in percent else percent)


def percentile_analysis(
    df: DataFrame,
    percentiles: Sequence[float] = DEFAULT_PERCENTILES,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
    exact: bool = True,
) -> DataFrame:
    """Percentiles of the numeric columns, linear interpolation, named p1, p5, p99.9."""
    cols = _numeric(df, cols, exclude)
    if exact:
        found = quantiles(df, cols, percentiles)
    else:
        row = df.agg(
            *[
                F.percentile_approx(quoted(c).cast("double"), list(percentiles), 10_000)
                for c in cols
            ]
        ).first()
        found = {c: row[i] or [None] * len(percentiles) for i, c in enumerate(cols)}
    fields = ["column string", "ordinal int"]
    fields += [f"`{percentile_name(p)}` double" for p in percentiles]
    rows = [(c, i, *found[c]) for i, c in enumerate(cols)]
    return report_frame(df.sparkSession, rows, ", ".join(fields))


DESCRIBE_SCHEMA = (
    "column string, ordinal int, count long, unique long, top string, freq long, "
    "mean double, std double, min double, p25 double, p50 double, p75 double, max double"
)


def describe(df: DataFrame, include: str = "all", numeric_only: bool = False) -> DataFrame:
    """Per-column summary. Numeric columns get moments and quartiles, others their mode.

    ``include="all"`` reports both kinds; any other value, or ``numeric_only``, reports
    the numeric columns only. A frame without such columns gives an empty table. Equally
    frequent values are told apart by the smallest text.
    """
    spark = df.sparkSession
    numeric = numeric_cols(df)
    others = [] if numeric_only or include != "all" else [c for c in df.columns if c not in numeric]
    position = {c: i for i, c in enumerate(df.columns)}
    parts = []
    if numeric:
        stats = {r["column"]: r for r in column_stats(df, numeric).collect()}
        counts = {c: stats[c]["n"] for c in numeric}
        quart = quantiles(df, numeric, (0.25, 0.5, 0.75), counts)
        rows = [
            (
                c, position[c], counts[c], None, None, None,
                stats[c]["mean"], stats[c]["std"], stats[c]["min"], *quart[c], stats[c]["max"],
            )
            for c in numeric
        ]
        parts.append(report_frame(spark, rows, DESCRIBE_SCHEMA))
    parts += [_describe_values(df, c, position[c]) for c in others]
    if not parts:
        return report_frame(spark, [], DESCRIBE_SCHEMA)
    return union_all(parts)


def _describe_values(df: DataFrame, column: str, ordinal: int) -> DataFrame:
    text = quoted(column).cast("string").alias("value")
    per_value = df.select(text).groupBy("value").agg(F.count("value").alias("n"))
    one = per_value.filter("value is not null").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.count("*").alias("unique"),
        F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("best"),
    )
    blank = F.lit(None).cast("double")
    return one.select(
        F.lit(column).alias("column"),
        F.lit(ordinal).alias("ordinal"),
        F.col("count"),
        F.col("unique"),
        F.col("best.value").alias("top"),
        (-F.col("best.minus_n")).alias("freq"),
        *[blank.alias(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def features_as_rows(table: DataFrame, statistic: str, name_col: str = "NameColumn") -> DataFrame:
    """Turn a statistics-by-feature report into one row per feature.

    ``statistic`` names the column that holds the row labels (count, mean, ...).
    """
    require_columns(table, [statistic])
    features = [c for c in table.columns if c != statistic]
    labels = [r[0] for r in table.select(statistic).collect()]
    long = table.unpivot(statistic, features, name_col, "value")
    return long.groupBy(name_col).agg(
        *[F.max(F.when(quoted(statistic) == s, F.col("value"))).alias(s) for s in labels]
    )


def histogram_edges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Range of each column that holds values; a constant gets half a unit on both sides."""
    row = df.agg(
        *[F.min(quoted(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(quoted(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    edges = {}
    for i, c in enumerate(cols):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None:
            edges[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    return edges


def histograms(
    df: DataFrame,
    bins: int = 30,
    max_columns: int | None = None,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
) -> DataFrame:
    """Counts in ``bins`` equal-width bins over [min, max], the last bin closed.

    Rows are counted per (column, bin) before anything is exchanged, so at most
    ``max_columns * bins`` groups leave each partition.
    """
    if bins < 1:
        raise ValueError("bins must be > 0")
    cols = _numeric(df, cols, exclude, max_columns)
    schema = "column string, ordinal int, bin int, lower double, upper double, n long"
    spark = df.sparkSession
    edges = histogram_edges(df, cols) if cols else {}
    if not edges:
        return report_frame(spark, [], schema)
    slots, frame_rows = [], []
    for i, c in enumerate(cols):
        if c not in edges:
            continue
        lo, hi = edges[c]
        width = (hi - lo) / bins
        v = quoted(c).cast("double")
        at = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        at = F.when(v.isNotNull(), at).cast("int")
        slots.append(F.struct(F.lit(i).alias("ordinal"), at.alias("bin")))
        frame_rows += [
            (c, i, b, lo + b * width, hi if b == bins - 1 else lo + (b + 1) * width)
            for b in range(bins)
        ]
    counted = (
        df.select(F.inline(F.array(*slots)))
        .filter("bin is not null")
        .groupBy("ordinal", "bin")
        .agg(F.count("*").alias("n"))
    )
    grid = report_frame(
        spark, frame_rows, "column string, ordinal int, bin int, lower double, upper double"
    )
    return grid.join(counted, ["ordinal", "bin"], "left").select(
        "column", "ordinal", "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")
    )


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value, missing included and listed last."""
    require_columns(df, [label], "label")
    return (
        df.groupBy(quoted(label).alias("label"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.asc_nulls_last("label"))
    )


def row_cap(report: DataFrame, max_rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``max_rows`` report rows, with a flag that says whether rows were cut off."""
    names = report.columns
    first = [quoted(c).alias(f"_key{i}") for i, c in enumerate(order_by)]
    one_more = report.orderBy(*[quoted(c) for c in order_by]).limit(max_rows + 1)
    gathered = one_more.agg(
        (F.count("*") > max_rows).alias("truncated"),
        F.slice(
            F.sort_array(F.collect_list(F.struct(*first, F.struct("*").alias("_row")))),
            1,
            max_rows,
        ).alias("rows"),
    )
    rows = gathered.select("truncated", F.explode("rows").alias("r"))
    return rows.select(*[F.col("r._row").getField(c).alias(c) for c in names], "truncated")


# --- quality checks: they report, they never change the data ---------------------------


def iqr_bounds(
    df: DataFrame, cols: Sequence[str], k: float = 1.5
) -> dict[str, tuple[float, float]]:
    out = {}
    for c, (q1, q3) in quantiles(df, cols, (0.25, 0.75)).items():
        if q1 is not None:
            out[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def zscore_params(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of the columns that have a positive deviation."""
    stats = column_stats(df, cols).collect()
    return {r["column"]: (r["mean"], r["std"]) for r in stats if r["std"]}


def is_zscore_outlier(column: Column, mean: float, std: float, threshold: float) -> Column:
    return F.abs((column - F.lit(mean)) / F.lit(std)) > F.lit(threshold)


def outlier_detection(
    df: DataFrame,
    method: str = "iqr",
    iqr_k: float = 1.5,
    zscore_threshold: float = 3.0,
    max_columns: int | None = None,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
) -> DataFrame:
    """Outliers per column with the bounds they violate."""
    cols = _numeric(df, cols, exclude, max_columns)
    if method == "iqr":
        limits = iqr_bounds(df, cols, iqr_k)
        hit = {
            c: (quoted(c) < F.lit(lo)) | (quoted(c) > F.lit(hi)) for c, (lo, hi) in limits.items()
        }
    elif method == "zscore":
        params = zscore_params(df, cols)
        limits = {
            c: (m - zscore_threshold * s, m + zscore_threshold * s) for c, (m, s) in params.items()
        }
        hit = {
            c: is_zscore_outlier(quoted(c), m, s, zscore_threshold) for c, (m, s) in params.items()
        }
    else:
        raise ValueError(f"method must be iqr or zscore, got {method}")
    never = F.lit(False)
    one = df.agg(
        *[F.count_if(hit.get(c, never)).alias(f"o{i}") for i, c in enumerate(cols)],
        *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(cols)],
    )
    blank = F.lit(None).cast("double")
    return long_report(
        one,
        [
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                "lower": F.lit(limits[c][0]) if c in limits else blank,
                "upper": F.lit(limits[c][1]) if c in limits else blank,
                "n": F.col(f"n{i}"),
                "outliers": F.col(f"o{i}"),
                "outlier_ratio": F.round(F.try_divide(F.col(f"o{i}"), F.col(f"n{i}")), 6),
            }
            for i, c in enumerate(cols)
        ],
    )


def duplicate_detection(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies; copies are merged before the exchange."""
    cols = _columns(df, subset)
    per_row = df.groupBy(*[quoted(c) for c in cols]).agg(F.count("*").alias("copies"))
    return per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_duplicates"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("largest_group"),
    )


def range_validation(df: DataFrame, rules: Sequence[tuple[str, float | None, float | None]]):
    """Values outside [low, high] per rule ``(column, low, high)``; ``None`` leaves a side open."""
    require_columns(df, [c for c, _, _ in rules])
    one_aggs, rows = [], []
    for i, (c, lo, hi) in enumerate(rules):
        v = quoted(c)
        under = v < F.lit(lo) if lo is not None else F.lit(False)
        over = v > F.lit(hi) if hi is not None else F.lit(False)
        one_aggs += [
            F.count_if(under).alias(f"u{i}"),
            F.count_if(over).alias(f"o{i}"),
            F.count(v).alias(f"n{i}"),
        ]
        rows.append(
            {
                "rule": F.lit(i),
                "column": F.lit(c),
                "n": F.col(f"n{i}"),
                "below": F.col(f"u{i}"),
                "above": F.col(f"o{i}"),
                "violations": F.col(f"u{i}") + F.col(f"o{i}"),
            }
        )
    return long_report(df.agg(*one_aggs), rows)


def inconsistency_checks(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that break, or cannot decide, each boolean SQL rule."""
    aggs, rows = [F.count("*").alias("rows")], []
    for i, (name, rule) in enumerate(rules.items()):
        holds = F.expr(rule)
        aggs += [F.count_if(~holds).alias(f"b{i}"), F.count_if(holds.isNull()).alias(f"u{i}")]
        rows.append(
            {
                "rule": F.lit(name),
                "n_rows": F.col("rows"),
                "violations": F.col(f"b{i}"),
                "undecided": F.col(f"u{i}"),
            }
        )
    return long_report(df.agg(*aggs), rows)


def boxplots(
    df: DataFrame,
    max_columns: int | None = None,
    k: float = 1.5,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
) -> DataFrame:
    """Five-number summary, whisker ends (extreme values within the fences) and outliers."""
    cols = _numeric(df, cols, exclude, max_columns)
    quart = quantiles(df, cols, (0.25, 0.5, 0.75))
    cols = [c for c in cols if quart[c][0] is not None]
    aggs, rows = [F.count("*").alias("rows")], []
    for i, c in enumerate(cols):
        q1, q2, q3 = quart[c]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        v = quoted(c).cast("double")
        within = v.between(F.lit(lo), F.lit(hi))
        aggs += [
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.min(F.when(within, v)).alias(f"wl{i}"),
            F.max(F.when(within, v)).alias(f"wh{i}"),
            F.count_if(~within).alias(f"o{i}"),
        ]
        rows.append(
            {
                "column": F.lit(c),
                "ordinal": F.lit(i),
                "min": F.col(f"lo{i}"),
                "whisker_low": F.col(f"wl{i}"),
                "q1": F.lit(q1),
                "median": F.lit(q2),
                "q3": F.lit(q3),
                "whisker_high": F.col(f"wh{i}"),
                "max": F.col(f"hi{i}"),
                "outliers": F.col(f"o{i}"),
            }
        )
    if not rows:
        return report_frame(
            df.sparkSession,
            [],
            "column string, ordinal int, min double, whisker_low double, q1 double, "
            "median double, q3 double, whisker_high double, max double, outliers long",
        )
    return long_report(df.agg(*aggs), rows)


def correlation_matrix(
    df: DataFrame,
    method: str = "pearson",
    max_columns: int | None = None,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
) -> DataFrame:
    """Upper triangle of the correlation matrix over pairwise complete rows.

    Spearman replaces each value by its average rank. The ranks of a column come from
    its distinct values, so they are taken over all its non-missing values.
    """
    cols = _numeric(df, cols, exclude, max_columns)
    data = df.select(*[quoted(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if method == "spearman":
        from sensorlens.operators.ranks import replace_by_ranks

        data = replace_by_ranks(data, [f"v{i}" for i in range(len(cols))])
    elif method != "pearson":
        raise ValueError(f"method must be pearson or spearman, got {method}")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return report_frame(df.sparkSession, [], "column_a string, column_b string, corr double")
    one = data.agg(*[F.corr(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs])
    return long_report(
        one,
        [
            {
                "column_a": F.lit(cols[i]),
                "column_b": F.lit(cols[j]),
                "corr": F.col(f"c{i}_{j}"),
            }
            for i, j in pairs
        ],
    )


def scatter_matrix(
    df: DataFrame,
    sample_rows: int = 10_000,
    max_columns: int | None = None,
    key: str = "id",
    random_state: int = 42,
) -> DataFrame:
    """``sample_rows`` rows of the numeric columns, or the first ones, chosen by a digest of the key."""
    cols = numeric_cols(df, [key])[:max_columns]
    chosen = df.select(quoted(key), *[quoted(c) for c in cols])
    return smallest_rows(chosen, sample_rows, split_number(quoted(key), random_state))


def pca_exploratory(
    df: DataFrame,
    n_components: int = 2,
    cols: Iterable[str] | None = None,
    exclude: Iterable[str] = ("id",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Principal components of the imputed, standardised numeric columns, one row per row."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    from sensorlens.operators.prep import PreprocessConfig, fit_numeric_preprocessor

    cols = _numeric(df, cols, exclude)
    vectors = fit_numeric_preprocessor(df, cols, PreprocessConfig("mean")).assemble(df)
    fitted = PCA(k=n_components, inputCol="features", outputCol="_pc").fit(vectors)
    parts = vector_to_array(F.col("_pc"))
    return fitted.transform(vectors).select(
        *[quoted(c) for c in keep],
        *[F.get(parts, F.lit(i)).alias(f"pc{i + 1}") for i in range(n_components)],
    )


def grouped_counts(
    df: DataFrame, column: str, by: Sequence[str], edges: Sequence[float], sets: Sequence[Sequence[str]]
) -> DataFrame:
    """Rows, mean and extremes of a column for several groupings at once, from one scan.

    ``by`` and ``bin`` (the interval between two ``edges`` that holds the value, the last one closed; missing
    outside) can be grouped; ``sets`` lists the groupings, an empty one being all rows. ``grouping``
    numbers them by the bits of the columns left out, so that a missing value differs from a column left out.
    """
    names = [*by, "bin"]
    require_columns(df, [column, *by])
    unknown = sorted({c for s in sets for c in s} - set(names))
    if unknown or list(edges) != sorted(set(edges)) or len(edges) < 2:
        raise ValueError(f"groupings must be of {names} and edges ascend, got {unknown}, {list(edges)}")
    value = quoted(column).cast("double")
    at = F.when(value == F.lit(float(edges[-1])), F.lit(len(edges) - 2))
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        at = at.when((value >= F.lit(float(low))) & (value < F.lit(float(high))), F.lit(i))
    rows = df.select(*[quoted(c) for c in by], value.alias("_value"), at.alias("bin"))
    grouped = rows.groupingSets([[quoted(c) for c in s] for s in sets], *[quoted(c) for c in names])
    return grouped.agg(
        F.grouping_id().alias("grouping"), F.count("*").alias("n"), F.avg("_value").alias("mean"),
        F.min("_value").alias("min"), F.max("_value").alias("max"),
    )
