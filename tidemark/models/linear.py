"""Linear models on the ML library, and their coefficient tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_ols(train: DataFrame, label: str) -> LinearRegressionModel:
    return LinearRegression(labelCol=label, regParam=0.0, solver="normal").fit(train)


def fit_ridge(train: DataFrame, label: str, alpha: float = 1.0) -> LinearRegressionModel:
    """Least squares plus alpha x squared weights, on features that are already standardized.

    The library divides the loss by the row count and scales the label by its deviation, hence the
    conversion of ``alpha``.
    """
    size = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    strength = alpha * size["sd"] / size["n"]
    return LinearRegression(
        labelCol=label, regParam=strength, elasticNetParam=0.0, standardization=False, solver="normal"
    ).fit(train)


def fit_lasso(train: DataFrame, label: str, alpha: float = 0.01, max_iter: int = 5000) -> LinearRegressionModel:
    return LinearRegression(
        labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False, solver="normal", maxIter=max_iter
    ).fit(train)


def coefficients(model: LinearRegressionModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per term, the intercept included; as many rows as the model has features."""
    rows = [("intercept", float(model.intercept))]
    rows += [(name, float(weight)) for name, weight in zip(names, model.coefficients)]
    return df.sparkSession.createDataFrame(rows, "term string, weight double").orderBy(F.abs("weight").desc())
