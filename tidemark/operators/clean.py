"""Null handling, constant columns and guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import forward_filled, series_window
from tidemark.plans.longseries import lerp_between
from tidemark.plans.ranking import long_format, quantiles
from tidemark.plans.scalar_stats import attach_row


def all_present(cols: Sequence[str]) -> Column:
    """One conjunction of plain not-null tests. The planner keeps each test as its own fact; a single
    test over all columns would be copied for every combination of later aliases."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.filter(all_present(list(subset) if subset else df.columns))


def count_dropped(df: DataFrame, required: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How many rows pass, and fail, the requirement that all columns hold a value."""
    mask = all_present(required)
    return df.groupBy(*by).agg(F.count_if(mask).alias("n_kept"), F.count_if(~mask).alias("n_dropped"))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(cols))


def fill_mean(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the column mean of the whole table, or of ``fit_on`` (for example train rows)."""
    source = df if fit_on is None else fit_on
    means = source.agg(*[F.avg(c).alias(c) for c in cols])
    return fill_from_row(df, cols, means)


def fill_from_row(df: DataFrame, cols: Sequence[str], row: DataFrame) -> DataFrame:
    """Fill nulls of each column by the value of the same name in a one-row table."""
    filled = {c: F.coalesce(F.col(c), F.col("_stats")[c]) for c in cols}
    return attach_row(df, row).withColumns(filled).drop("_stats")


def fill_train_median(df: DataFrame, cols: Sequence[str], split: str = "split") -> DataFrame:
    """Fill nulls in all splits with medians of the train rows, with one ranking for all columns."""
    train = long_format(df.filter(F.col(split) == "train"), cols)
    medians = quantiles(train, "value", {"median": 0.5}, by=["variable"])
    row = medians.agg(*[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(c) for c in cols])
    return fill_from_row(df, cols, row)


def forward_fill_zero(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Forward fill within the series, then 0 (only the start of a series is left to fill)."""
    w = series_window(keys)
    return df.withColumns({c: F.coalesce(forward_filled(c, w), F.lit(0.0)) for c in cols})


def interpolate(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), zero: bool = True) -> DataFrame:
    """Linear interpolation by row position within the series, then 0 for leading nulls.

    The next known value is the last one in reversed order: a frame that ends at the end of the
    series would be evaluated anew for every row.
    """
    numbered = df.withColumn("_pos", F.row_number().over(series_window(keys)))
    so_far = (Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*keys).orderBy("_pos").rowsBetween(*so_far)
    backward = Window.partitionBy(*keys).orderBy(F.col("_pos").desc()).rowsBetween(*so_far)
    ends = []
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(c).alias("value")))
        ends.append(F.last(known, True).over(onward).alias(f"_prev_{c}"))
        ends.append(F.last(known, True).over(backward).alias(f"_next_{c}"))
    found = numbered.select("*", *ends)
    filled = {c: lerp_between(f"_prev_{c}", f"_next_{c}", F.col("_pos")) for c in cols}
    if zero:
        filled = {c: F.coalesce(x, F.lit(0.0)) for c, x in filled.items()}
    return found.withColumns(filled).select(*df.columns)


def spread_of_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: smallest and largest value, and whether it is constant. One pass."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
                F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("is_constant"),
            )
            for c in cols
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def varying_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with at least two different values (reads one row of results per column)."""
    spread = {r["variable"]: r["is_constant"] for r in spread_of_columns(df, cols).collect()}
    return [c for c in cols if not spread[c]]


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing or not cols:
        raise ValueError(f"required columns are missing: {missing}" if cols else "no required columns given")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def require_parsed(df: DataFrame, col: str) -> DataFrame:
    """Let the job fail at the first row whose date could not be parsed."""
    message = F.lit(f"unparsed value in {col}")
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.col(col)).otherwise(F.raise_error(message).cast("date")))


def guard_report(df: DataFrame, date: str, required: Sequence[str], split: str, splits: Sequence[str]) -> DataFrame:
    """Rows of (check, failures): missing columns, null dates, repeated keys are counted in one pass."""
    checks = [F.struct(F.lit("null dates").alias("check"), F.count_if(F.col(date).isNull()).alias("failures"))]
    for c in required:
        absent = F.lit(1).cast("bigint") if c not in df.columns else F.lit(0).cast("bigint")
        checks.append(F.struct(F.lit(f"column {c}").alias("check"), absent.alias("failures")))
    for s in splits:
        empty = (F.count_if(F.col(split) == s) == 0).cast("bigint")
        checks.append(F.struct(F.lit(f"split {s} empty").alias("check"), empty.alias("failures")))
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
