"""Time-based splits as a ``split`` column, and the check that they do not overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import back_in_time
from tidemark.plans.longseries import index_rows
from tidemark.plans.scalar_stats import constants


def split_relative(df: DataFrame, date: str = "date", validation: bool = True) -> DataFrame:
    """Test is the last year up to the newest date, validation the year before, train the rest."""
    newest = constants(df, {"newest": F.max(date)})["newest"]
    test_from, val_from = back_in_time(newest, years=1), back_in_time(back_in_time(newest, years=1), years=1)
    label = F.when(F.col(date) >= test_from, "test")
    if validation:
        label = label.when(F.col(date) >= val_from, "val")
    return df.withColumn("split", F.when(F.col(date).isNotNull(), label.otherwise("train")))


def split_by_year(
    df: DataFrame, test_from: int, test_to: int | None = None, val_year: int | None = None, date: str = "date"
) -> DataFrame:
    """Train before the validation year (or test start), test from ``test_from`` to ``test_to``."""
    year = F.year(date)
    test = year >= test_from if test_to is None else year.between(test_from, test_to)
    label = F.when(test, "test").when(year < (val_year or test_from), "train")
    if val_year is not None:
        label = label.when(year == val_year, "val")
    return df.withColumn("split", label)


def split_fraction(df: DataFrame, test_share: float = 0.2, keys: Sequence[str] = (), order: str = "date") -> DataFrame:
    """Chronological split of each daily series: the last ceil(share x rows) rows are test."""
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    label = F.when(position <= rows - F.ceil(F.lit(test_share) * rows), "train").otherwise("test")
    return df.withColumn("split", label)


def split_fraction_rows(df: DataFrame, order: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """The same split over all rows of a raw table of any length, ordered by a unique key."""
    numbered = index_rows(df, [], order)
    rows = constants(numbered, {"rows": F.count(F.lit(1))})["rows"]
    label = F.when(F.col("_rn") < rows - F.ceil(F.lit(test_share) * rows), "train").otherwise("test")
    return numbered.withColumn("split", label).drop("_rn")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows and percent of all rows per split."""
    sizes = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    share = F.lit(100.0) * F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy())  # one row per split
    return sizes.withColumn("pct", share)


def leakage_check(df: DataFrame, date: str = "date") -> DataFrame:
    """One row: the date limits of the splits, and whether each ends before the next begins."""

    def edge(agg, name: str):
        return agg(F.when(F.col("split") == name, F.col(date)))

    limits = df.agg(
        edge(F.max, "train").alias("train_to"),
        edge(F.min, "val").alias("val_from"),
        edge(F.max, "val").alias("val_to"),
        edge(F.min, "test").alias("test_from"),
    )
    has_val = F.col("val_from").isNotNull()
    in_order = F.when(has_val, (F.col("train_to") < F.col("val_from")) & (F.col("val_to") < F.col("test_from")))
    return limits.withColumn("ok", in_order.otherwise(F.col("train_to") < F.col("test_from")))


def assert_no_leakage(df: DataFrame, date: str = "date") -> DataFrame:
    if not leakage_check(df, date).first()["ok"]:
        raise ValueError("splits overlap in time")
    return df


def union_splits(*parts: DataFrame) -> DataFrame:
    """Rows of all parts under one schema."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
