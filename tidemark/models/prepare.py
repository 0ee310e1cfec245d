"""From a feature table to vectors: missing values, assembly, and the train rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import drop_nulls, fill_train_median
from tidemark.plans.scratch import written


@dataclass(frozen=True)
class Matrix:
    """A written table with ``features``, a label and a ``split``, and the names behind the vector."""

    table: DataFrame
    names: tuple[str, ...]
    label: str

    def part(self, *splits: str) -> DataFrame:
        return self.table.filter(F.col("split").isin(*splits))

    @property
    def train(self) -> DataFrame:
        return self.part("train")


def assemble(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(df)


def scale_vectors(df: DataFrame, fit_on: DataFrame) -> DataFrame:
    """Zero mean and unit population deviation, measured on ``fit_on``. The library divides by the
    sample deviation, so a constant factor takes the vectors from one to the other."""
    rows = fit_on.count()
    scaler = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True).fit(fit_on)
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    widen = ElementwiseProduct(
        inputCol="_scaled", outputCol="features", scalingVec=Vectors.dense([factor] * len(scaler.mean))
    )
    return widen.transform(scaler.transform(df).drop("features")).drop("_scaled")


def matrix(
    df: DataFrame,
    names: Sequence[str],
    label: str,
    missing: str = "drop",
    scale: bool = False,
    train_splits: Sequence[str] = ("train",),
) -> Matrix:
    """Assemble the features. ``missing`` drops rows with a gap, or fills gaps with train medians and
    adds a 0/1 column per feature that says so. ``scale`` standardizes with train statistics.

    The rows are written once, since a fit reads them several times.
    """
    names = list(names)
    usable = df.filter(F.col(label).isNotNull() & F.col("split").isNotNull())
    if missing == "median":
        flags = {f"{n}_missing": F.col(n).isNull().cast("double") for n in names}
        usable = fill_train_median(written(usable.withColumns(flags)), names)
        names = [*names, *flags]
    else:
        usable = drop_nulls(usable, names)
    table = written(assemble(usable, names))
    if scale:
        table = scale_vectors(table, table.filter(F.col("split").isin(*train_splits)))
    return Matrix(table, tuple(names), label)


def predict_with(model, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Score rows and keep only the new column next to the old ones."""
    scored = model.transform(df)
    kept = [c for c in df.columns if c != "prediction"]
    return scored.select(*kept, F.col("prediction").alias(name))
