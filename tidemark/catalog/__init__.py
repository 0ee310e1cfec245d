"""Named queries over the given tables, each with the SQL that states the same result."""

from tidemark.catalog.base import QUERIES, SQL

from tidemark.catalog import (  # noqa: F401  (each module adds its queries)
    evaluation,
    features,
    modelling,
    preparation,
    raw_series,
    scans,
    statistics,
)

__all__ = ["QUERIES", "SQL"]
