"""Past-only window features as column expressions.

Each function takes the window it runs over, so the same expression works on a daily table
(``series_window``), inside each split, or per chunk of a long raw series
(``plans.longseries.over_chunks``). Put all features of one table into one ``select``: columns with
the same window share one sort. Frames count rows, not calendar days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio

# Weights of the third-last, second-last and last row in the weighted mean.
WEIGHTS_OLD_TO_NEW = [0.1, 0.3, 0.6]


def series_window(keys: Sequence[str] = (), order: str = "date") -> WindowSpec:
    """Rows of one series in time order. The table must have one row per (series, date)."""
    return Window.partitionBy(*keys).orderBy(order)


def lag(col: str, k: int, w: WindowSpec) -> Column:
    return F.lag(col, k).over(w)


def lags(col: str, ks: Sequence[int], w: WindowSpec, name: str = "{col}_lag{k}") -> list[Column]:
    return [lag(col, k, w).alias(name.format(col=col, k=k)) for k in ks]


def rolling_mean(col: str, n: int, w: WindowSpec, strict: bool = True) -> Column:
    """Mean of the previous ``n`` rows. Strict: null unless all of them hold a value."""
    frame = w.rowsBetween(-n, -1)
    mean = F.avg(col).over(frame)
    return F.when(F.count(col).over(frame) == n, mean) if strict else mean


def rolling_means(
    col: str, ns: Sequence[int], w: WindowSpec, strict: bool = True, name: str = "{col}_roll{n}"
) -> list[Column]:
    return [rolling_mean(col, n, w, strict).alias(name.format(col=col, n=n)) for n in ns]


def rolling_sum(col: str, k: int, w: WindowSpec) -> Column:
    """Sum of the current row and the ``k`` rows before it; null unless all hold a value."""
    frame = w.rowsBetween(-k, 0)
    return F.when(F.count(col).over(frame) == k + 1, F.sum(col).over(frame))


def lag_diff(col: str, near: int, far: int, w: WindowSpec) -> Column:
    return lag(col, near, w) - lag(col, far, w)


def lag_filled(col: str, k: int, w: WindowSpec) -> Column:
    """Lag, then forward fill: the last value known ``k`` rows ago."""
    return F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -k))


def forward_filled(col: str, w: WindowSpec) -> Column:
    return F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def weighted_past(col: str, w: WindowSpec) -> Column:
    """Weighted mean of the three rows before the current one, each forward filled."""
    oldest, middle, newest = WEIGHTS_OLD_TO_NEW
    return lag_filled(col, 3, w) * oldest + lag_filled(col, 2, w) * middle + lag_filled(col, 1, w) * newest


def weighted_current(col: str, w: WindowSpec) -> Column:
    """Weighted mean of the current row and the two before it."""
    oldest, middle, newest = WEIGHTS_OLD_TO_NEW
    return lag(col, 2, w) * oldest + lag(col, 1, w) * middle + F.col(col) * newest


def pct_change(col: str, k: int, w: WindowSpec) -> Column:
    """Relative change of the last row against ``k`` rows ago; no value for ``k`` = 1."""
    if k == 1:
        return F.lit(None).cast("double")
    return ratio(lag_diff(col, 1, k, w), lag(col, k, w))


def spike_ratio(col: str, w: WindowSpec, n: int = 7, strict: bool = True, epsilon: float = 0.0) -> Column:
    """Last row against the mean of the last ``n`` rows."""
    return ratio(lag(col, 1, w), rolling_mean(col, n, w, strict), epsilon)


def yesterday(cols: Sequence[str], w: WindowSpec, rolls: Sequence[int] = (3, 7)) -> list[Column]:
    """Yesterday's value and relaxed rolling means up to yesterday, for each column."""
    picked = []
    for col in cols:
        picked.append(lag(col, 1, w).alias(f"{col}_yesterday"))
        picked += rolling_means(col, rolls, w, strict=False, name="{col}_yesterday_{n}day")
    return picked


def per_target(cols: Sequence[str], w: WindowSpec, ks: Sequence[int], ns: Sequence[int]) -> list[Column]:
    """The same lags, strict rolling means and 1-to-7 ratio for several targets."""
    picked = []
    for col in cols:
        picked += rolling_means(col, ns, w, name="{col}_roll_{n}day")
        picked += lags(col, ks, w, name="{col}_lag_{k}")
        picked.append(spike_ratio(col, w).alias(f"{col}_ratio_1d_7d"))
    return picked


def products(pairs: Sequence[tuple[str, str]], have: Sequence[str]) -> list[Column]:
    """Interaction products of the pairs whose two members both exist."""
    return [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in pairs if a in have and b in have]


def on_calendar(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """One row for every day between the first and last date of each series, so that row lags are
    day lags. Days without data hold nulls."""
    span = df.groupBy(*keys).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    days = span.select(*keys, F.explode(F.sequence("_from", "_to")).alias(date))
    return days.join(df, [*keys, date], "left")
