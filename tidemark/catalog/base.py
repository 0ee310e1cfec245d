"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.daily import SQL_TABLES

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` is its DuckDB statement, absent where SQL cannot express it."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def daily_sql(body: str, *tables: str) -> str:
    """SQL over the derived daily tables, with further named tables in between."""
    return "WITH " + ",\n".join([SQL_TABLES.strip(), *tables]) + "\n" + body


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round computed doubles: the last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def r(column: Column | str, name: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(name)


def big(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})
