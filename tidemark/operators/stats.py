"""Profiles, distributions and correlations.

Every statistic is one aggregation with partial results per task, or goes through
``plans.ranking`` where an order over all rows is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import drop_nulls
from tidemark.plans.ranking import average_rank, join_group_stats, long_format, quantiles, ranked_counts
from tidemark.plans.scalar_stats import attach_row, constants
from tidemark.plans.scratch import written

DAYS_PER_YEAR = 365.25
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _rows(structs: list[Column], df: DataFrame) -> DataFrame:
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def profile_span(df: DataFrame, date: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Row count, first and last date, and the span in days and years."""
    days = F.date_diff(F.max(date), F.min(date))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        days.cast("bigint").alias("span_days"),
        (days / F.lit(DAYS_PER_YEAR)).alias("span_years"),
    )


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per column, one row per column."""
    return _rows(
        [
            F.struct(
                F.lit(c).alias("variable"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
                F.avg(c).alias("mean_value"),
            )
            for c in cols
        ],
        df,
    )


def group_mean(df: DataFrame, by: Sequence[str | Column], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def value_counts(df: DataFrame, col: str, every: DataFrame | None = None) -> DataFrame:
    """Rows per value, in value order. ``every`` lists values that must appear, with 0 if unused; it
    drops no other value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if every is not None:
        counts = every.join(counts, col, "full").na.fill(0, ["n"])
    return counts.orderBy(col)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column."""
    cells = long_format(df, cols)
    moments = _rows(
        [
            F.struct(
                F.lit(c).alias("variable"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            )
            for c in cols
        ],
        df,
    )
    quartiles = quantiles(cells, "value", QUARTILES, ["variable"])
    return moments.join(quartiles, "variable", "left")


def null_info(df: DataFrame) -> DataFrame:
    """Type, present and missing values per column."""
    types = dict(df.dtypes)
    return _rows(
        [
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(types[c]).alias("dtype"),
                F.count(c).alias("n_present"),
                (F.count(F.lit(1)) - F.count(c)).alias("n_null"),
            )
            for c in df.columns
        ],
        df,
    )


def null_mask(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The missingness matrix: 1 where a value is absent."""
    return df.select(*keys, *[F.col(c).isNull().cast("int").alias(c) for c in cols])


def null_matrix(df: DataFrame, cols: Sequence[str], period: Column) -> DataFrame:
    """Missing values per period and column: the matrix at a size that can be shown."""
    return df.groupBy(period.alias("period")).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def _products(values: DataFrame, means: Sequence[float]) -> tuple[np.ndarray, ...]:
    """Over the rows where two columns both hold a value, for every pair: rows, sums of the first, sums of
    its squares, and sums of products (columns x columns each), of values taken from their means.

    Value, square and presence of every column stand side by side in one vector, so one Gram matrix of
    these vectors holds all of it. Each task keeps one such matrix, and they are merged pairwise.
    """
    parts = [F.coalesce(F.col(c) - F.lit(m), F.lit(0.0)) for c, m in zip(values.columns, means)]
    held = [F.col(c).isNotNull().cast("double") for c in values.columns]
    rows = values.select(array_to_vector(F.array(*parts, *[x * x for x in parts], *held)).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v")).computeGramianMatrix().toArray()
    x, q, m = (slice(i * len(parts), (i + 1) * len(parts)) for i in range(3))
    return gram[m, m], gram[x, m], gram[q, m], gram[x, x]


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of every ordered pair of columns over the rows where both hold a value.

    Two scans, one for the means and one for all products, and no shuffle of rows. A pair in which a column
    does not vary has no correlation; a column with itself has 1.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    first = values.agg(F.count(F.lit(1)), *[F.avg(c) for c in values.columns]).first()
    means = [m or 0.0 for m in first[1:]]
    n = s = q = xy = np.zeros((len(cols), len(cols)))
    if first[0]:
        n, s, q, xy = _products(values, means)
    spread = n * q - s * s
    # what is left of a constant column after rounding does not count as spread
    varies = spread > (n * np.abs(means)[:, None] * 1e-12) ** 2
    both = varies & varies.T
    r = np.where(both, (n * xy - s * s.T) / np.sqrt(np.where(both, spread * spread.T, 1.0)), np.nan)
    np.fill_diagonal(r, 1.0)
    rows = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j]), int(n[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "var_a string, var_b string, r double, n bigint")


def strong_pairs(matrix: DataFrame, over: float = 0.4) -> DataFrame:
    """Pairs of different columns whose correlation exceeds the limit in size."""
    return matrix.filter((F.abs("r") > over) & (F.col("var_a") != F.col("var_b")))


def target_ranking(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of each column with the target, strongest positive first."""
    ranked = _rows(
        [F.struct(F.lit(c).alias("variable"), F.corr(c, target).alias("r")) for c in cols if c != target], df
    )
    return ranked.orderBy(F.col("r").desc())


def null_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of the missingness of columns."""
    return pearson(null_mask(df, [], cols), cols)


def with_ranks(df: DataFrame, cols: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """Average ranks of each column over the whole table, in the place of its values.

    Only counts of distinct (variable, value) are ranked, in one range-partitioned pass. A row looks its
    ranks up in the written result, column by column: in memory where a column's values are few enough to
    be broadcast, else with one exchange of the rows for that column. A hot value is one row on the
    ranking side, so a skewed join can be split. Null stays null.
    """
    ranks = ranked_counts(long_format(df, cols), "value", ["variable"]).select("variable", "value", average_rank().alias("rank"))
    ranks = written(ranks)
    placed = df.select(*row_key, *[F.col(c).cast("double").alias(f"_value_{i}") for i, c in enumerate(cols)])
    for i, c in enumerate(cols):
        mine = ranks.filter(F.col("variable") == c).select(F.col("value").alias(f"_value_{i}"), F.col("rank").alias(f"_rank_{i}"))
        placed = placed.join(mine, f"_value_{i}", "left")
    return placed.select(*row_key, *[F.col(f"_rank_{i}").alias(c) for i, c in enumerate(cols)])


def spearman(df: DataFrame, cols: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """Rank correlation over the rows in which every column holds a value."""
    complete = written(drop_nulls(df.select(*row_key, *cols), cols))
    return pearson(with_ranks(complete, cols, row_key), cols)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; empty bins are kept."""
    limits = constants(df, {"lo": F.min(col), "hi": F.max(col)})
    width = (limits["hi"] - limits["lo"]) / F.lit(float(bins))
    position = F.least(F.floor(F.try_divide(F.col(col) - limits["lo"], width)), F.lit(bins - 1))
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.coalesce(position, F.lit(0)).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    left = limits["lo"] + F.col("bin") * width
    return grid.join(counts, "bin", "left").select(
        "bin", left.alias("bin_from"), (left + width).alias("bin_to"), F.coalesce("n", F.lit(0)).alias("n")
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 quartile ranges) and outliers per group."""
    known = df.select(*by, col).filter(F.col(col).isNotNull())
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    boxes = quantiles(known, col, QUARTILES, by).withColumns(
        {"_low": F.col("q25") - reach, "_high": F.col("q75") + reach}
    )
    inside = F.col(col).between(F.col("_low"), F.col("_high"))
    return (
        join_group_stats(known, boxes, by)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.max(q).alias(q) for q in QUARTILES],
            F.min(F.when(inside, F.col(col))).alias("whisker_low"),
            F.max(F.when(inside, F.col(col))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def outlier_rows(df: DataFrame, col: str, boxes: DataFrame) -> DataFrame:
    """The rows outside the whiskers of one ungrouped box."""
    fence = constants(boxes, {"low": F.max("whisker_low"), "high": F.max("whisker_high")})
    return df.filter((F.col(col) < fence["low"]) | (F.col(col) > fence["high"]))


def class_weights(df: DataFrame, label: str, labels: Sequence[int]) -> DataFrame:
    """Balanced weights rows / (classes x rows of the class). An absent class counts as 1e-6 rows."""
    total = F.count(label)
    counts = {k: F.count_if(F.col(label) == k) for k in labels}
    present = sum((F.when(n > 0, 1).otherwise(0) for n in counts.values()), F.lit(0))
    return _rows(
        [
            F.struct(
                F.lit(k).cast("int").alias("label"),
                n.alias("n"),
                (total / (present * F.when(n > 0, n.cast("double")).otherwise(F.lit(1e-6)))).alias("weight"),
            )
            for k, n in counts.items()
        ],
        df,
    )


def with_class_weight(df: DataFrame, label: str, labels: Sequence[int], fit_on: DataFrame) -> DataFrame:
    """Add the balanced weight of each row's class, measured on ``fit_on``."""
    weights = class_weights(fit_on, label, labels)
    per_class = weights.agg(*[F.max(F.when(F.col("label") == k, F.col("weight"))).alias(f"w{k}") for k in labels])
    chosen = F.lit(None).cast("double")
    for k in labels:
        chosen = F.when(F.col(label) == k, F.col("_stats")[f"w{k}"]).otherwise(chosen)
    return attach_row(df, per_class).withColumn("weight", chosen).drop("_stats")


def distinct_values(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.select(column.alias(name)).distinct()


def standardized(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    moments = []
    for c in cols:
        width = F.stddev_pop(c)
        moments += [F.avg(c).alias(f"m_{c}"), F.when(width > 0, width).otherwise(F.lit(1.0)).alias(f"s_{c}")]
    stats = F.col("_stats")
    scaled = {c: (F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] for c in cols}
    return attach_row(df, source.agg(*moments)).withColumns(scaled).drop("_stats")


def simple_ols(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Trend line of y on x by sums."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


