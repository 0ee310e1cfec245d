"""Boosted trees that stop by patience, their nodes as a table, and boosted levels.

The ML library stops boosting at the first round whose gain on validation rows is below a tolerance.
Here a fit is followed by its validation loss after every round (one pass over the validation rows),
and it ends at the best round once so many rounds brought nothing better. Until that happens the fit is
repeated with twice the rounds, so at most about four times the rounds that were needed are fitted.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import scratch_root

AUC_BINS = 1000


@dataclass(frozen=True)
class Staged:
    """A model cut to its best round, and the validation loss after each round that was tried."""

    model: object
    losses: tuple[float, ...]
    limit: int

    @property
    def kept(self) -> int:
        return self.model.getNumTrees

    def curve(self, df: DataFrame) -> DataFrame:
        """One row per round that was tried: round (from 1), loss, kept (whether the model has it)."""
        rows = [(i, float(x), i <= self.kept) for i, x in enumerate(self.losses, 1)]
        return df.sparkSession.createDataFrame(rows, "round int, loss double, kept boolean")


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) with the least loss before ``patience`` rounds in a row brought nothing better,
    and whether that happened. The first of equal losses counts; a loss that is no number is never best."""
    best, least = 0, math.inf
    for i, loss in enumerate(losses):
        if loss < least:
            best, least = i, loss
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_with_patience(fit: Callable[[int], object], losses: Callable[[object], Sequence[float]], limit: int, patience: int) -> Staged:
    """``fit`` takes a number of rounds; ``losses`` gives the validation loss after each round of a fit."""
    rounds = min(limit, patience + max(patience // 2, 1))
    while True:
        model = fit(rounds)
        found = list(losses(model))
        best, ended = best_round(found, patience)
        if ended or rounds >= limit or len(found) < rounds:
            return Staged(cut(model, best), tuple(found), limit)
        rounds = min(limit, 2 * rounds)


def cut(model, rounds: int):
    """The first ``rounds`` trees of a boosted model."""
    inner = model._java_obj
    trees, weights = list(inner.trees()), list(inner.treeWeights())
    if rounds >= len(trees):
        return model
    jvm = SparkContext._active_spark_context._gateway.jvm
    kept = JavaWrapper._new_java_array(trees[:rounds], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    shares = JavaWrapper._new_java_array(weights[:rounds], jvm.double)
    name = "regression.GBTRegressionModel" if isinstance(model, GBTRegressionModel) else "classification.GBTClassificationModel"
    short = JavaWrapper._new_java_obj(f"org.apache.spark.ml.{name}", inner.uid(), kept, shares)
    return type(model)(short).setFeaturesCol(model.getFeaturesCol())


def node_table(model, spark: SparkSession) -> DataFrame:
    """Nodes of a fitted tree model: tree, node (in pre-order), feature (null: a leaf), prediction, gain.

    They are read from the saved form of the model, so the driver does not hold them.
    """
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        "prediction",
        F.when(inner, F.col("gain")).alias("gain"),
    )


def split_counts(model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """How often each feature splits a node of the trees, most often first; 0 for a feature never used."""
    every = spark.createDataFrame(list(enumerate(names)), "feature int, name string")
    counts = node_table(model, spark).filter("feature is not null").groupBy("feature").agg(F.count("*").alias("n"))
    found = every.join(F.broadcast(counts), "feature", "left").select(F.col("name").alias("feature"), F.col("feature").alias("position"), F.coalesce("n", F.lit(0)).alias("splits"))
    return found.orderBy(F.desc("splits"), "position")


def _leaf_values(model, spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """Prediction of each leaf times the weight of its tree, leaves in pre-order, tree after tree; and where
    each tree begins. As large as the model itself."""
    leaves = node_table(model, spark).filter("feature is null").groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("node", "prediction"))).alias("leaves"))
    weights = list(model.treeWeights)
    values: list[list[float]] = [[] for _ in weights]
    for row in leaves.collect():
        values[row["tree"]] = [leaf["prediction"] * weights[row["tree"]] for leaf in row["leaves"]]
    return np.concatenate(values), np.cumsum([0, *map(len, values[:-1])])


def staged_auc(model, df: DataFrame, label: str, bins: int = AUC_BINS) -> list[float]:
    """Area under the ROC curve after each round, probabilities taken in ``bins`` equal steps (those in one
    step count as ties). Each task adds up its margins tree by tree and gives out counts per (round, step).
    Without rows of both classes the area is no number."""
    values, begins = _leaf_values(model, df.sparkSession)
    rounds = len(begins)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, rounds * bins), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                leaves = part.column(1).flatten().to_numpy().reshape(part.num_rows, rounds).astype(np.int64)
                margin = values[leaves + begins].cumsum(1)
                step = np.minimum(bins / (1 + np.exp(-2 * margin)), bins - 1).astype(np.int64) + np.arange(rounds) * bins
                hit = part.column(0).to_numpy(zero_copy_only=False) > 0
                for kind, rows in enumerate((~hit, hit)):
                    counts[kind] += np.bincount(step[rows].ravel(), minlength=rounds * bins)
        used = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], names=["cell", "misses", "hits"])

    scored = model.copy().setLeafCol("_leaves").transform(df.select(label, "features"))
    leaves = scored.select(F.col(label).cast("double").alias("label"), vector_to_array("_leaves").alias("leaves"))
    summed = leaves.mapInArrow(count, "cell bigint, misses bigint, hits bigint").groupBy("cell").agg(F.sum("misses").alias("misses"), F.sum("hits").alias("hits"))
    cells = summed.withColumn("round", F.expr(f"cast(cell div {bins} as int)"))
    below = Window.partitionBy("round").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("hits") * (F.coalesce(F.sum("misses").over(below), F.lit(0)) + F.col("misses") / 2)
    areas = cells.withColumn("won", won).groupBy("round").agg(F.try_divide(F.sum("won"), F.sum("hits") * F.sum("misses")).alias("auc"))
    found = {r["round"]: r["auc"] for r in areas.collect()}
    return [math.nan if found.get(i) is None else found[i] for i in range(rounds)]


def at_once(jobs: Sequence[Callable[[], object]], threads: int = 4) -> list:
    """Results of independent fits whose Spark jobs run side by side."""
    if not jobs:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(threads, len(jobs))) as pool:
        return pool.map(lambda job: inherit(job)(), jobs)


@dataclass(frozen=True)
class BoostedLevels:
    """One boosted model for each level that the train rows hold, their probabilities coupled to sum to 1."""

    levels: tuple[int, ...]
    staged: tuple[Staged | None, ...]  # None: all train rows have this level

    def with_level(self, df: DataFrame, name: str = "predicted", probabilities: str | None = None) -> DataFrame:
        """Add the most probable level (the lower of equal ones), and the probabilities if a name is given."""
        scored, columns = df, df.columns
        for level, fit in zip(self.levels, self.staged):
            column = f"_level{level}"
            if fit is None:
                scored = scored.withColumn(column, F.lit(1.0))
            else:
                scored = fit.model.transform(scored).withColumn(column, vector_to_array("probability")[1])
                scored = scored.drop("probability", "rawPrediction", "prediction")
        found = [F.col(f"_level{level}") for level in self.levels]
        total = sum(found[1:], found[0])
        shares = F.array(*[x / total for x in found])
        best = F.get(F.array(*[F.lit(x) for x in self.levels]), F.array_position(shares, F.array_max(shares)).cast("int") - 1)
        more = [shares.alias(probabilities)] if probabilities else []
        return scored.select(*columns, best.alias(name), *more)


def fit_levels(train: DataFrame, label: str, fit: Callable[[DataFrame, str], Staged], known: Column, threads: int = 4) -> BoostedLevels:
    """One booster per level against the rest. ``fit`` takes rows and the name of a 0/1 label; ``known``
    marks the rows whose levels are modelled.

    A level that no such row has gets no model and is never predicted; rows without a level teach nothing.
    """
    rows = train.filter(F.col(label).isNotNull())
    levels = sorted(r[0] for r in rows.filter(known).select(F.col(label).cast("int")).distinct().collect())
    if not levels:
        raise ValueError(f"no row has a level in {label}")
    if len(levels) == 1:
        return BoostedLevels((levels[0],), (None,))
    jobs = [lambda level=level: fit(rows.withColumn("_is_level", (F.col(label) == level).cast("double")), "_is_level") for level in levels]
    return BoostedLevels(tuple(levels), tuple(at_once(jobs, threads)))
