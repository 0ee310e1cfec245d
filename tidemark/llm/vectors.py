"""Vectors in tasks: checks in the JVM, matrices from binary columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """A vector that is not null or empty and has neither null nor non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def matrix(column: pd.Series, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1).astype(np.float64 if dtype != "<i8" else np.int64)


def pack(column: pd.Series, dtype: str) -> list[bytes]:
    return [np.asarray(v, dtype=dtype).tobytes() for v in column]
