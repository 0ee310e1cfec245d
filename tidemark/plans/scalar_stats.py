"""Single-row statistics used inside other queries without a cross join.

A one-row aggregate becomes a scalar subquery. It runs as its own job, fails if it would return two
rows, and its values reach the main query as constants.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(stats: DataFrame) -> dict[str, Column]:
    """The columns of a one-row table as constants, for a handful of uses."""
    row = stats.select(F.struct(*stats.columns).alias("row")).scalar()
    return {name: row[name] for name in stats.columns}


def attach_row(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """Add the one-row table as a struct column. For many statistics: the subquery is planned once,
    not once per use."""
    return df.withColumn(name, stats.select(F.struct(*stats.columns).alias("row")).scalar())


def constants(df: DataFrame, aggregates: Mapping[str, Column]) -> dict[str, Column]:
    """Aggregates over the whole table as constants."""
    return one_row(df.agg(*[agg.alias(name) for name, agg in aggregates.items()]))
