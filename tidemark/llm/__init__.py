"""Operators of a training-data pipeline, and the queries that run them over the given tables."""

from tidemark.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
