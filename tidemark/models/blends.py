"""Predictions made of several models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models import trees as T
from tidemark.models.boosting import at_once
from tidemark.models.prepare import predict_with


def mean_of(models: Sequence, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Equal-weight mean of several regressors, scored in one pass over the rows."""
    scored = df
    for i, model in enumerate(models):
        scored = predict_with(model, scored, f"_p{i}")
    parts = [F.col(f"_p{i}") for i in range(len(models))]
    mean = sum(parts[1:], parts[0]) / len(parts)
    return scored.withColumn(name, mean).drop(*[f"_p{i}" for i in range(len(models))])


def fit_two_stage(
    train: DataFrame, target: str = "target_asinh", spike: str = "is_spike", how: T.Boosting = T.MIXTURE,
    classifier: T.Boosting | None = None,
) -> tuple:
    """A spike classifier, and one regressor each for the quiet and the spike rows.

    Validation rows marked by ``how.stop_on`` steer all three fits, whatever their own label.
    """
    held = F.col(how.stop_on) if how.stop_on else F.lit(False)
    return tuple(at_once([
        lambda: T.fit_spike_classifier(train, spike, classifier or how),
        lambda: T.fit_boosted(train.filter((F.col(spike) == 0) | held), target, how),
        lambda: T.fit_boosted(train.filter((F.col(spike) == 1) | held), target, how),
    ]))


def two_stage_predict(models: tuple, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Mix of both regressors by spike probability in asinh space, taken back by sinh."""
    classifier, quiet, spiky = models
    scored = T.with_probability(classifier, df, "_p")
    scored = predict_with(spiky, predict_with(quiet, scored, "_quiet"), "_spiky")
    mixed = F.col("_p") * F.col("_spiky") + (1 - F.col("_p")) * F.col("_quiet")
    return scored.withColumn(name, F.sinh(mixed)).withColumnRenamed("_p", "spike_probability").drop("_quiet", "_spiky")
