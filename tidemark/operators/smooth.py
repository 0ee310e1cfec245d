"""Smooth curves on a grid: Gaussian density and local linear regression.

The grid is a fixed number of points. Each row adds its share to every grid point inside its own
task, and only the per-point sums are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import drop_nulls
from tidemark.plans.ranking import quantiles
from tidemark.plans.scalar_stats import constants
from tidemark.plans.scratch import written

INV_SQRT_2PI = 0.3989422804014327


def _grid_point(limits: dict[str, Column], points: int) -> Column:
    return limits["lo"] + F.col("point") * ((limits["hi"] - limits["lo"]) / F.lit(float(points - 1)))


def _per_point(df: DataFrame, points: int) -> DataFrame:
    return df.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))


def kernel_density(df: DataFrame, col: str, points: int = 50) -> DataFrame:
    """Gaussian density at evenly spaced points, bandwidth by Scott's rule (n^-1/5 x deviation)."""
    known = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    stats = constants(
        known, {"lo": F.min("x"), "hi": F.max("x"), "sd": F.stddev_samp("x"), "n": F.count("x").cast("double")}
    )
    bandwidth = stats["sd"] * F.pow(stats["n"], F.lit(-0.2))
    u = (_grid_point(stats, points) - F.col("x")) / bandwidth
    sums = _per_point(known, points).groupBy("point").agg(F.sum(F.exp(-0.5 * u * u)).alias("mass"))
    scale = F.lit(INV_SQRT_2PI) / (stats["n"] * bandwidth)
    return sums.select("point", _grid_point(stats, points).alias("x"), (F.col("mass") * scale).alias("density"))


def _line(s: dict[str, float]) -> float | None:
    """Weighted least-squares line at its centre from sums over offsets d; the mean where it is flat."""
    if not s["sw"]:
        return None
    spread = s["sw"] * s["swdd"] - s["swd"] ** 2
    if spread > 1e-9 * s["sw"] ** 2:
        return (s["swdd"] * s["swy"] - s["swd"] * s["swdy"]) / spread
    return s["swy"] / s["sw"]


def lowess(df: DataFrame, x: str, y: str, fraction: float = 2 / 3, points: int = 20, robust: int = 3) -> DataFrame:
    """Robust local linear regression on an even grid: tricube weights over the nearest share of rows, then
    ``robust`` further rounds in which a row counts by the bisquare of its residual over six median residuals.

    A residual is taken from the straight line between the fits of the two grid points around a row, so a
    row's weight follows from the last curve and nothing is kept for each row. The distance to the k-th
    nearest row of a grid point and the median are exact (quantiles narrowed down by a sketch). Each
    round shuffles five sums per grid point. A point whose rows all lost their weight keeps its last fit;
    where the median residual is 0, only rows on the curve count. No rows give no points.
    """
    spark = df.sparkSession
    known = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = written(drop_nulls(known))
    lo, hi, n = known.agg(F.min("x"), F.max("x"), F.count(F.lit(1))).first()
    schema = "point int, x double, fitted double"
    if not n:
        return spark.createDataFrame([], schema)
    step = (hi - lo) / (points - 1)
    grid = np.array([lo + p * step for p in range(points)])
    cells = _per_point(known, points).withColumn("d", F.col("x") - F.get(F.lit(grid), F.col("point")))
    k = max(math.ceil(fraction * n), 2)
    reach = quantiles(cells.select("point", F.abs("d").alias("reach")), "reach", {"h": (k - 1) / max(n - 1, 1)}, ["point"])
    width = np.array([r["h"] for r in reach.orderBy("point").collect()])  # one row per grid point
    u = F.coalesce(F.try_divide(F.abs("d"), F.get(F.lit(width), F.col("point"))), F.when(F.col("d") == 0, 0.0).otherwise(1.0))
    near = F.when(u < 1, F.pow(1 - F.pow(u, F.lit(3.0)), F.lit(3.0))).otherwise(F.lit(0.0))

    def fit(trust: Column) -> list[float | None]:
        weighted = cells.withColumn("w", near * trust)
        terms = {"sw": "w", "swd": "w * d", "swdd": "w * d * d", "swy": "w * y", "swdy": "w * d * y"}
        sums = weighted.groupBy("point").agg(*[F.sum(F.expr(e)).alias(name) for name, e in terms.items()])
        return [_line(r.asDict()) for r in sums.orderBy("point").collect()]

    def residual(fitted: np.ndarray) -> Column:
        at = F.least(F.greatest(F.floor((F.col("x") - lo) / step), F.lit(0)), F.lit(points - 2)).cast("int") if step else F.lit(0)
        left, right = F.get(F.lit(fitted), at), F.get(F.lit(fitted), at + 1)
        along = (F.col("x") - F.get(F.lit(grid), at)) / step if step else F.lit(0.0)
        return F.abs(F.col("y") - left - (right - left) * along)

    fitted = np.array(fit(F.lit(1.0)), np.float64)
    for _ in range(robust):
        gap = residual(fitted)
        median = quantiles(known.select(gap.alias("gap")), "gap", {"m": 0.5}).first()["m"]
        u2 = F.when(gap > 0, F.lit(1.0)).otherwise(F.lit(0.0)) if median == 0 else gap / (6 * median)
        trust = F.when(u2 < 1, F.pow(1 - u2 * u2, F.lit(2.0))).otherwise(F.lit(0.0))
        fitted = np.array([before if now is None else now for now, before in zip(fit(trust), fitted)], np.float64)
    rows = [(p, float(grid[p]), float(fitted[p])) for p in range(points)]
    return spark.createDataFrame(rows, schema)


def knee_point(costs: DataFrame, k: str = "k", cost: str = "cost") -> DataFrame:
    """The k with the largest gap between a falling convex curve and its chord, both scaled to 0-1."""
    limits = constants(
        costs, {"k0": F.min(k), "k1": F.max(k), "c0": F.min(cost), "c1": F.max(cost)}
    )
    along = F.try_divide(F.col(k) - limits["k0"], limits["k1"] - limits["k0"])
    height = F.try_divide(F.col(cost) - limits["c0"], limits["c1"] - limits["c0"])
    gaps = costs.select(F.col(k).alias("k"), F.col(cost).alias("cost"), (1 - along - height).alias("gap"))
    return gaps.orderBy(F.col("gap").desc(), F.col("k")).limit(1)
