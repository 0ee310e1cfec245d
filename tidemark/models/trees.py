"""Tree models on the ML library.

Defaults are the published settings. Boosting stops on the rows of a validation split after a number of
rounds without improvement, and keeps the trees up to the best round (see ``boosting``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.boosting import BoostedLevels, Staged, fit_levels, fit_with_patience, split_counts, staged_auc


@dataclass(frozen=True)
class Forest:
    trees: int = 600
    depth: int = 10
    min_leaf: int = 1
    subset: str = "auto"
    seed: int = 42


@dataclass(frozen=True)
class Boosting:
    rounds: int = 800
    depth: int = 4
    step: float = 0.03
    rows: float = 0.8
    subset: str = "0.7"
    seed: int = 42
    min_leaf: int = 1
    stop_on: str | None = None  # boolean column that marks validation rows
    patience: int = 50  # rounds without improvement


# Published settings of the regressors.
DEPTH_WISE = Boosting(rounds=800, depth=4, step=0.03, rows=0.8, subset="0.7")
LEAF_WISE = Boosting(rounds=900, depth=5, step=0.01, rows=0.8, subset="0.8")
DAILY_POLLEN = Boosting(rounds=1200, depth=6, step=0.05, rows=0.8, subset="0.8")
LOG_POLLEN = Boosting(rounds=1000, depth=5, step=0.05, rows=1.0, subset="all")
MIXTURE = Boosting(rounds=3000, depth=6, step=0.03, rows=0.8, subset="0.8", min_leaf=40)
SPIKE_CLASSIFIER = Boosting(rounds=5000, depth=5, step=0.05, rows=0.8, subset="0.8", min_leaf=20)
LEVELS = Boosting(rounds=1000, depth=5, step=0.05, rows=1.0, subset="all", min_leaf=20)
LOG_FOREST = Forest(trees=200, depth=30, min_leaf=4, subset="all")


def fit_forest(train: DataFrame, label: str, how: Forest = Forest(), weight: str | None = None):
    forest = RandomForestRegressor(
        labelCol=label, numTrees=how.trees, maxDepth=how.depth, minInstancesPerNode=how.min_leaf,
        featureSubsetStrategy=how.subset, seed=how.seed,
    )
    return (forest.setWeightCol(weight) if weight else forest).fit(train)


def _booster(kind, label: str, how: Boosting, weight: str | None):
    booster = kind(
        labelCol=label, maxDepth=how.depth, stepSize=how.step, subsamplingRate=how.rows,
        featureSubsetStrategy=how.subset, minInstancesPerNode=how.min_leaf, seed=how.seed,
    )
    return booster.setWeightCol(weight) if weight else booster


def staged_fit(train: DataFrame, label: str, how: Boosting, weight: str | None = None, loss: str = "rmse") -> Staged:
    """Fit on the rows that ``how.stop_on`` does not mark, cut at the best round on those it marks.

    ``loss``: ``rmse`` for a number; ``auc`` (1 - area under the ROC curve) or ``log`` for a 0/1 label.
    """
    held = F.coalesce(F.col(how.stop_on), F.lit(False))
    rows, validation = train.filter(~held), train.filter(held).filter(F.col(label).isNotNull())
    if validation.isEmpty():
        raise ValueError(f"no row is marked by {how.stop_on}: nothing to stop on")
    losses = {
        "rmse": lambda model: [math.sqrt(x) for x in model.evaluateEachIteration(validation, "squared")],
        "log": lambda model: model.evaluateEachIteration(validation),
        "auc": lambda model: [1 - x for x in staged_auc(model, validation, label)],
    }[loss]
    booster = _booster(GBTRegressor if loss == "rmse" else GBTClassifier, label, how, weight)
    return fit_with_patience(lambda rounds: booster.setMaxIter(rounds).fit(rows), losses, how.rounds, how.patience)


def fit_boosted(train: DataFrame, label: str, how: Boosting = DEPTH_WISE, weight: str | None = None):
    """``train`` holds the validation rows too if ``how.stop_on`` marks them; without it all rounds are kept."""
    if how.stop_on:
        return staged_fit(train, label, how, weight).model
    return _booster(GBTRegressor, label, how, weight).setMaxIter(how.rounds).fit(train)


def refit_boosted(train: DataFrame, label: str, how: Boosting = DEPTH_WISE, weight: str | None = None):
    """Choose the rounds on the validation rows, then fit so many on all rows, validation rows included."""
    rounds = staged_fit(train, label, how, weight).kept
    return _booster(GBTRegressor, label, how, weight).setMaxIter(rounds).fit(train)


def with_validation_flag(df: DataFrame, name: str = "is_validation", split: str = "val") -> DataFrame:
    return df.withColumn(name, F.col("split") == split)


def fit_spike_classifier(train: DataFrame, label: str = "is_spike", how: Boosting = SPIKE_CLASSIFIER):
    """Stops on the area under the ROC curve of the validation rows, if ``how.stop_on`` marks them."""
    if how.stop_on:
        return staged_fit(train, label, how, loss="auc").model
    return _booster(GBTClassifier, label, how, None).setMaxIter(how.rounds).fit(train)


def fit_boosted_levels(train: DataFrame, label: str, how: Boosting = LEVELS, weight: str | None = "weight") -> BoostedLevels:
    """Several levels: one booster per level against the rest, each with class weights and a stop of its own
    on the logistic loss of the validation rows; probabilities are coupled."""

    def one(rows: DataFrame, is_level: str) -> Staged:
        if how.stop_on:
            return staged_fit(rows, is_level, how, weight, "log")
        model = _booster(GBTClassifier, is_level, how, weight).setMaxIter(how.rounds).fit(rows)
        return Staged(model, (), how.rounds)

    held = F.coalesce(F.col(how.stop_on), F.lit(False)) if how.stop_on else F.lit(False)
    return fit_levels(train, label, one, known=~held)


def with_probability(model, df: DataFrame, name: str = "probability_of_1") -> DataFrame:
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def importances(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per feature, largest first; importances sum to 1."""
    weights = model.featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(names, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def important_positions(model, names: Sequence[str], df: DataFrame, splits: int = 50, fallback: int = 10) -> list[int]:
    """Positions of features that split more than ``splits`` nodes, or else of the ``fallback`` best."""
    counts = split_counts(model, names, df.sparkSession).collect()  # one row per feature
    return [r["position"] for r in counts if r["splits"] > splits] or [r["position"] for r in counts[:fallback]]


def keep_features(df: DataFrame, positions: Sequence[int], name: str = "kept") -> DataFrame:
    """Replace the feature vector by the chosen positions."""
    sliced = VectorSlicer(inputCol="features", outputCol=name, indices=sorted(positions)).transform(df)
    return sliced.drop("features").withColumnRenamed(name, "features")
