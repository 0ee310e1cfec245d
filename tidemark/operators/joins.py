"""Joins of daily tables. Both sides hold one row per key, so no key multiplies rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_all(tables: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join any number of tables on the same key."""
    return reduce(lambda left, right: left.join(right, list(keys), how), tables)


def join_full_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which null keys match each other; the key columns are merged."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    merged = [F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys]
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return left.join(renamed, same, "full").select(*merged, *rest)


def align_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring columns of ``right`` to the rows of ``left``; rows absent on the right get null."""
    return left.join(right, list(keys), "left")


def keep_matching(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right.select(*keys), list(keys), "left_semi")
