"""Table and metric writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, by_year_of: str | None = None) -> None:
    """Parquet; ``by_year_of`` names a date column whose year becomes the folder level."""
    if by_year_of:
        df = df.selectExpr("*", f"year(`{by_year_of}`) AS year_of")
        df.write.mode("overwrite").partitionBy("year_of").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A metrics summary is a few rows: one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
