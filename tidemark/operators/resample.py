"""Resampling of daily tables to months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Mean per calendar month, labelled by the month's last day. Months without rows, between the
    first and last month of a series, are kept with null means."""
    month = F.last_day(date)
    means = df.groupBy(*keys, month.alias("month_end")).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])
    span = df.groupBy(*keys).agg(F.trunc(F.min(date), "month").alias("a"), F.trunc(F.max(date), "month").alias("b"))
    every = F.explode(F.sequence("a", "b", F.expr("interval 1 month")))
    calendar = span.select(*keys, every.alias("m")).select(*keys, F.last_day("m").alias("month_end"))
    return calendar.join(means, [*keys, "month_end"], "left")
