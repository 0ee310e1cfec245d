"""Spike labels, weights and train-statistic transforms on daily series.

Statistics come from the train rows of the same series, by a window over the series: the rows are
already placed by series for the lag features, so this adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import flag, to_col, winsorize

# Fixed values of the spike rules.
Z_LIMIT = 1.64
Z_EPSILON = 1e-8
MIN_TRAIN_ROWS = 5
SPIKE_WEIGHT = 10


def train_only(x: Column | str, split: str = "split") -> Column:
    return F.when(F.col(split) == "train", to_col(x))


def over_series(agg: Column, keys: Sequence[str]) -> Column:
    return agg.over(Window.partitionBy(*keys))


def mean_std_threshold(x: str, keys: Sequence[str], split: str = "split") -> Column:
    """Train mean plus sample deviation; with under 5 train rows the median takes the mean's place,
    and without any the median of all rows stands alone."""
    known = train_only(x, split)
    rows = over_series(F.count(known), keys)
    deviation = over_series(F.stddev_samp(known), keys)
    few = over_series(F.median(known), keys) + deviation
    return (
        F.when(rows >= MIN_TRAIN_ROWS, over_series(F.avg(known), keys) + deviation)
        .when(rows > 0, few)
        .otherwise(over_series(F.median(x), keys))
    )


def train_quantile(x: str, q: float, keys: Sequence[str], split: str | None = "split") -> Column:
    """Exact quantile of the train rows of the daily series, or of all rows if ``split`` is None."""
    known = train_only(x, split) if split else to_col(x)
    return over_series(F.percentile(known, q), keys)


def spike_over_threshold(lag1: str, threshold: Column) -> Column:
    return flag(F.col(lag1) > threshold)


def spike_over_jump(lag1: str, roll: str, keys: Sequence[str], split: str | None = "split", q: float = 0.75) -> Column:
    """The last row exceeds the rolling mean by more than the q quantile of the rolling mean."""
    return flag(F.col(lag1) - F.col(roll) > train_quantile(roll, q, keys, split))


def spike_over_roll(lag1: str, roll: str) -> Column:
    return flag(F.col(lag1) > F.col(roll))


def z_score(x: str, keys: Sequence[str], split: str = "split") -> Column:
    """Distance from the train mean in population deviations of the train rows."""
    known = train_only(x, split)
    centre, width = over_series(F.avg(known), keys), over_series(F.stddev_pop(known), keys)
    return (F.col(x) - centre) / (width + F.lit(Z_EPSILON))


def spike_over_z(x: str, keys: Sequence[str], split: str = "split", limit: float = Z_LIMIT) -> Column:
    return flag(z_score(x, keys, split) > limit)


def spike_weight(is_spike: str = "is_spike", weight: float = SPIKE_WEIGHT) -> Column:
    return F.when(F.col(is_spike) == 1, float(weight)).otherwise(1.0)


def winsorized(x: str, keys: Sequence[str], split: str = "split", q: float = 0.99) -> Column:
    return winsorize(x, train_quantile(x, q, keys, split))


def with_log_target(df: DataFrame, x: str, keys: Sequence[str], split: str = "split") -> DataFrame:
    """Winsorized target and its log1p."""
    capped = df.withColumn(f"{x}_capped", winsorized(x, keys, split))
    return capped.withColumn(f"log_{x}", F.log1p(f"{x}_capped"))
