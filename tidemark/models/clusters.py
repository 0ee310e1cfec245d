"""K-means, cluster profiles, elbow costs and principal components on standardized features.

Several numbers of clusters are fitted together: one pass over the rows moves the centres of all of them,
with sums per (k, centre) from each task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.prepare import assemble, scale_vectors
from tidemark.operators.clean import drop_nulls
from tidemark.plans.scratch import written

SEED_ROWS = 20_000  # rows that first centres are drawn from
STEPS = 20
TOLERANCE = 1e-4  # a centre that moves less has settled


def scaled_vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without gaps, with ``features`` standardized and the source columns untouched."""
    known = written(assemble(drop_nulls(df, cols), cols))
    return scale_vectors(known, known)


def fit_clusters(vectors: DataFrame, k: int, seed: int = 42) -> KMeansModel:
    return KMeans(k=k, seed=seed, initMode="k-means||", featuresCol="features").fit(vectors)


def with_cluster(vectors: DataFrame, k: int, seed: int = 42) -> DataFrame:
    scored = fit_clusters(vectors, k, seed).transform(vectors)
    return scored.withColumnRenamed("prediction", "cluster")


def cluster_profile(labelled: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and mean of every feature per cluster."""
    means = [F.avg(c).alias(f"mean_{c}") for c in cols]
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *means)


def assignment_cost(model: KMeansModel, vectors: DataFrame) -> float:
    """Sum of squared distances to the final centres. The training summary of the library states the
    cost one step earlier."""
    centres = np.asarray(model.clusterCenters())
    flat, width = F.lit(centres.ravel()), centres.shape[1]
    mine = F.slice(flat, F.col("prediction") * width + 1, width)
    squares = F.zip_with(vector_to_array("features"), mine, lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
    return float(model.transform(vectors).agg(F.sum(distance).alias("cost")).first()["cost"])


def _sample(vectors: DataFrame, rows: int) -> np.ndarray:
    """About ``rows`` vectors (all, if fewer) chosen by a hash of their values, in a fixed order."""
    known = vectors.select(vector_to_array("features").alias("v"))
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(rows / total * (1 << 30)))
    found = np.array([r["v"] for r in known.collect()], np.float64)
    return found[np.lexsort(found.T)] if len(found) else found


def _spread(sample: np.ndarray, most: int, seed: int) -> np.ndarray:
    """Up to ``most`` different points, each drawn by its squared distance to those before."""
    rng = np.random.default_rng(seed)
    centres = [sample[rng.integers(len(sample))]]
    gap = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < most and gap.sum() > 0:
        centres.append(sample[rng.choice(len(sample), p=gap / gap.sum())])
        gap = np.minimum(gap, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def _sums(vectors: DataFrame, centres: dict[int, np.ndarray]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray], dict[int, float]]:
    """For every k: rows and summed vectors of each centre, and the summed squared distance to the nearest."""
    ks = sorted(centres)
    every = np.concatenate([centres[k] for k in ks])
    begins = np.cumsum([0, *[len(centres[k]) for k in ks]])
    width, norms = every.shape[1], (every**2).sum(1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, cost = np.zeros(len(every), np.int64), np.zeros((len(every), width)), np.zeros(len(every))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width)
            for at in range(0, len(x), 256):
                part = x[at : at + 256]
                far = (part**2).sum(1)[:, None] - 2 * part @ every.T + norms
                near = np.stack([begins[i] + far[:, begins[i] : begins[i + 1]].argmin(1) for i in range(len(ks))], 1)
                for i in range(len(ks)):
                    gap = part - every[near[:, i]]
                    cost[begins[i]] += (gap * gap).sum()
                flat = near.ravel()
                n += np.bincount(flat, minlength=len(every))
                for j in range(width):
                    s[:, j] += np.bincount(flat, np.repeat(part[:, j], len(ks)), len(every))
        ends = pa.array(np.arange(len(every) + 1, dtype=np.int32) * width)
        columns = [pa.array(np.arange(len(every)), pa.int32()), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(s.ravel())), pa.array(cost)]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "n", "s", "cost"])

    parts = vectors.select(vector_to_array("features").alias("v")).mapInArrow(add, "cell int, n bigint, s array<double>, cost double")
    total = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(width)])
    rows = total.toPandas().sort_values("cell")  # a row for each centre
    n, cost, s = rows["n"].to_numpy(), rows["cost"].to_numpy(), rows[[f"s{j}" for j in range(width)]].to_numpy()
    cut = {k: slice(begins[i], begins[i + 1]) for i, k in enumerate(ks)}
    return {k: n[c] for k, c in cut.items()}, {k: s[c] for k, c in cut.items()}, {k: float(cost[c].sum()) for k, c in cut.items()}


def _settle(vectors: DataFrame, centres: dict[int, np.ndarray], steps: int) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """Centres of every k after Lloyd's steps, and the costs at them. A centre without rows stays."""
    centres, moving = dict(centres), sorted(centres)
    for _ in range(steps):
        n, s, _ = _sums(vectors, {k: centres[k] for k in moving})
        still = []
        for k in moving:
            new = np.where(n[k][:, None] > 0, s[k] / np.maximum(n[k], 1)[:, None], centres[k])
            if np.sqrt(((new - centres[k]) ** 2).sum(1)).max() > TOLERANCE:
                still.append(k)
            centres[k] = new
        moving = still
        if not moving:
            break
    return centres, _sums(vectors, centres)[2]


def fit_together(vectors: DataFrame, ks: Iterable[int], seed: int = 42, steps: int = STEPS, seed_rows: int = SEED_ROWS) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """Centres and cost (summed squared distances) for every k of ``ks``.

    First centres are drawn from about ``seed_rows`` rows, and those of k are the first k of them. Where k
    ends with a higher cost than the next smaller number, it starts again from that one's centres and the
    sampled point farthest from them, so costs never rise with k. There are fewer than k centres if the
    sample has fewer different points.
    """
    vectors, ks = written(vectors), sorted(set(ks))
    sample = _sample(vectors, seed_rows)
    if not len(sample):
        raise ValueError("no rows to cluster")
    first = _spread(sample, ks[-1], seed)
    centres, costs = _settle(vectors, {k: first[:k] for k in ks}, steps)
    while True:
        rising = [k for before, k in zip(ks, ks[1:]) if costs[k] > costs[before]]
        again = {}
        for before, k in zip(ks, ks[1:]):
            if k in rising and before not in rising:
                start = centres[before]
                while len(start) < k:
                    gap = ((sample[:, None, :] - start[None]) ** 2).sum(2).min(1)
                    if gap.max() == 0:
                        break
                    start = np.concatenate([start, sample[gap.argmax()][None]])
                again[k] = start
        if not again:
            return centres, costs
        better, lower = _settle(vectors, again, steps)
        for k in again:
            before = ks[ks.index(k) - 1]
            # nothing left to gain (all points are centres): the smaller number's centres stand
            centres[k], costs[k] = (better[k], lower[k]) if lower[k] <= costs[before] else (centres[before], costs[before])


def with_nearest(vectors: DataFrame, centres: np.ndarray, name: str = "cluster") -> DataFrame:
    """Add the number of the nearest centre (the smaller of equally near ones)."""
    flat, width = F.lit(centres.ravel()), centres.shape[1]
    v = vector_to_array("features")

    def far(i):
        squares = F.zip_with(F.slice(flat, i * width + 1, width), v, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)

    gaps = F.transform(F.sequence(F.lit(0), F.lit(len(centres) - 1)), far)
    nearest = F.transform(F.array(gaps), lambda g: F.array_position(g, F.array_min(g)))[0] - 1
    return vectors.withColumn(name, nearest.cast("int"))


def elbow_costs(vectors: DataFrame, ks: Iterable[int], seed: int = 42) -> DataFrame:
    """Sum of squared distances to the nearest centre for each k."""
    _, costs = fit_together(vectors, ks, seed)
    return vectors.sparkSession.createDataFrame(sorted(costs.items()), "k bigint, cost double").orderBy("k")


def two_components(vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """First two principal components; the vectors are already centred."""
    model = PCA(k=2, inputCol="features", outputCol="components").fit(vectors)
    parts = vector_to_array("components")
    return model.transform(vectors).select(*keep, parts[0].alias("pc1"), parts[1].alias("pc2"))
