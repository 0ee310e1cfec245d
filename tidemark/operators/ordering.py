"""Sorts and top-k reports. A top-k is planned as per-task heaps, not as a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_date(df: DataFrame, *cols: str) -> DataFrame:
    return df.orderBy(*(cols or ("date",)))


def by_size(df: DataFrame, col: str) -> DataFrame:
    """Largest absolute value first."""
    return df.orderBy(F.abs(col).desc())


def top_k(df: DataFrame, col: str, k: int, tie: str | None = None, ascending_output: bool = True) -> DataFrame:
    """The k largest rows, shown smallest first as a bar chart needs them."""
    order = [F.col(col).desc()] + ([F.col(tie)] if tie else [])
    best = df.orderBy(*order).limit(k)
    return best.orderBy(col, *([tie] if tie else [])) if ascending_output else best


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
