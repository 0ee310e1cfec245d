"""Complete feature sets for air quality and pollen models.

Each set is one ``select`` over one series window (a second one where a forward fill follows a
rolling mean). ``within_split`` adds the split to the window, so that features start afresh in each
split; otherwise they run through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalars import calendar_parts, cyclic, flag
from tidemark.operators import labels as L
from tidemark.operators import windows as W
from tidemark.operators.clean import drop_nulls, forward_fill_zero, interpolate

# Lag and rolling lengths of the feature sets.
LONG_LAGS = [1, 2, 3, 4, 7, 14, 21, 30]
LONG_ROLLS = [2, 3, 7, 14, 30]


@dataclass(frozen=True)
class Columns:
    """Which columns of the joined daily table play which part."""

    keys: tuple[str, ...] = ()
    target: str = "total"
    pollutants: tuple[str, ...] = ("pm25", "o3", "co", "no2", "so2")
    weather: tuple[str, ...] = ("temp", "wind", "rain")
    pairs: tuple[tuple[str, str], ...] = ()
    types: tuple[str, ...] = ("tree", "grass", "weed")
    extra: tuple[str, ...] = field(default=())


AIR = Columns(target="aqi", pairs=(("pm25", "wind"), ("o3", "temp"), ("no2", "wind")))
POLLEN = Columns(pairs=(("temp", "aqi"), ("apparent", "pm25"), ("wind", "o3")))


def _window(columns: Columns, within_split: bool) -> WindowSpec:
    return W.series_window([*columns.keys, "split"] if within_split else columns.keys)


def _season(date: str, day_period: float, weekday: bool = False, month: bool = True) -> list[Column]:
    parts = calendar_parts(date)
    cycles = {"day": (parts["day_of_year"], day_period)}
    if month:
        cycles["month"] = (parts["month"], 12)
    if weekday:
        cycles["weekday"] = (parts["weekday"], 7)
    picked = []
    for name, (value, period) in cycles.items():
        sine, cosine = cyclic(value, period)
        picked += [sine.alias(f"{name}_sin"), cosine.alias(f"{name}_cos")]
    return picked


def aqi_feature_columns(columns: Columns, w: WindowSpec) -> list[Column]:
    """The 53 air quality features: target 6, pollutants 25, weather 9, interactions 3, calendar 10."""
    t = columns.target
    picked = W.lags(t, [2, 3], w) + W.rolling_means(t, [3, 7], w)
    picked += [W.lag_diff(t, 1, far, w).alias(f"{t}_diff{far}") for far in (2, 7)]
    for p in columns.pollutants:
        picked += W.lags(p, [1, 3, 7], w) + W.rolling_means(p, [3, 7], w)
    for c in columns.weather:
        picked += W.lags(c, [1], w) + W.rolling_means(c, [3, 7], w)
    picked += [(W.lag(a, 1, w) * W.lag(b, 1, w)).alias(f"{a}_{b}") for a, b in columns.pairs]
    parts = calendar_parts("date")
    picked += [parts[name].alias(name) for name in ("month", "day_of_year", "weekday", "is_weekend")]
    return picked + _season("date", 365, weekday=True)


def aqi_features(df: DataFrame, columns: Columns = AIR, within_split: bool = False) -> DataFrame:
    """Keys, date, target, split (if there) and the 53 features; rows without full history dropped."""
    w = _window(columns, within_split)
    base = [*columns.keys, "date", columns.target, *(["split"] if "split" in df.columns else [])]
    return drop_nulls(df.select(*base, *aqi_feature_columns(columns, w)))


def feature_names(df: DataFrame, columns: Columns) -> list[str]:
    """Features are what the builder added: an allow-list, so no raw column slips in."""
    skip = {*columns.keys, "date", "split", columns.target, "label", "weight"}
    return [c for c in df.columns if c not in skip]


def pollen_basic(df: DataFrame, columns: Columns, split: str = "split") -> DataFrame:
    """Relaxed rolling means, current-day weighted means, same-day products and the train-threshold
    spike. Rows without three earlier days are dropped."""
    w = W.series_window(columns.keys)
    t = columns.target
    picked = W.lags(t, [1, 2, 3], w, "lag{k}") + W.rolling_means(t, [3, 7], w, False, "pollen_{n}day")
    picked += _season("date", 365, month=False)
    for c in (*columns.weather, *columns.pollutants):
        picked.append(W.weighted_current(c, w).alias(f"{c}_weighted3"))
        picked += W.lags(c, [1, 2, 3], w)
    picked += W.products(columns.pairs, df.columns)
    spiky = L.spike_over_threshold("lag1", L.mean_std_threshold(t, columns.keys, split))
    kept = ["lag1", "lag2", "lag3", "pollen_3day", "pollen_7day"]
    return drop_nulls(df.select("*", *picked).withColumn("is_spike", spiky), kept)


def pollen_past_only(df: DataFrame, columns: Columns) -> DataFrame:
    """Forward-filled lags and strict rolling means, past-only weighted means, spike against the
    3-day mean."""
    w = W.series_window(columns.keys)
    t = columns.target
    picked = [W.lag_filled(t, k, w).alias(f"lag{k}") for k in (1, 2, 3)]
    picked += W.rolling_means(t, [3, 7], w, True, "_raw_{n}day")
    for c in (*columns.weather[:1], *columns.pollutants):
        picked.append(W.weighted_past(c, w).alias(f"{c}_weighted3"))
        picked += [W.lag_filled(c, k, w).alias(f"{c}_lag{k}") for k in (1, 2, 3)]
    picked += _season("date", 365, month=False) + W.products(columns.pairs, df.columns)
    built = df.select("*", *picked)
    filled = [W.forward_filled(f"_raw_{n}day", w).alias(f"pollen_{n}day") for n in (3, 7)]
    built = built.select("*", *filled).drop("_raw_3day", "_raw_7day")
    built = built.withColumn("is_spike", L.spike_over_roll("lag1", "pollen_3day"))
    return drop_nulls(built, ["lag1", "lag2", "lag3", "pollen_3day", "pollen_7day"])


def pollen_log(df: DataFrame, columns: Columns, split: str = "split") -> DataFrame:
    """Lags to 30 days, strict rolling means to 30 days, 1-to-7-day ratio; then the winsorized log
    target, the ratio spike and its weight, all from train rows."""
    w = W.series_window(columns.keys)
    t = columns.target
    picked = _season("date", 365) + W.rolling_means(t, LONG_ROLLS, w, True, "pollen_{n}day")
    picked += W.lags(t, LONG_LAGS, w, "lag_{k}") + [W.spike_ratio(t, w).alias("ratio_1d_7d")]
    built = drop_nulls(df.select("*", *picked), ["pollen_30day"])
    limit = L.train_quantile("ratio_1d_7d", 0.95, columns.keys, split)
    built = built.withColumn("is_spike", flag(F.col("ratio_1d_7d") > limit))
    return L.with_log_target(built, t, columns.keys, split).withColumn("weight", L.spike_weight())


def pollen_per_type(df: DataFrame, columns: Columns) -> DataFrame:
    """The same lags, rolling means and ratio for each pollen type."""
    w = W.series_window(columns.keys)
    picked = _season("date", 365) + W.per_target(columns.types, w, LONG_LAGS, [2, 7, 30])
    return drop_nulls(df.select("*", *picked), [f"{t}_roll_30day" for t in columns.types])


def pollen_two_stage(df: DataFrame, columns: Columns, year_lag: bool = True, causal: bool = False) -> DataFrame:
    """Calendar cycles, lags with relative changes, relaxed means, weather up to yesterday. Rows without
    any earlier target are dropped.

    Gaps of numeric source columns are interpolated, which looks at later rows, also across a split; with
    ``causal`` the last known value goes on instead. What is left is 0.
    """
    w = W.series_window(columns.keys)
    t = columns.target
    ks = [*LONG_LAGS, 365] if year_lag else LONG_LAGS
    picked = _season("date", 365.25, weekday=True)
    picked += [calendar_parts("date")[n].alias(n) for n in ("day_of_year", "month", "weekday")]
    picked += W.lags(t, ks, w, "lag_{k}")
    picked += [W.pct_change(t, k, w).alias(f"lag_{k}_pct") for k in ks if k > 1]
    picked += W.rolling_means(t, LONG_ROLLS, w, False, "pollen_{n}day")
    picked.append(W.spike_ratio(t, w, strict=False, epsilon=L.Z_EPSILON).alias("ratio_1d_7d"))
    picked += W.yesterday(columns.weather, w)
    built = df.select("*", *picked)
    sources = [c for c in (t, *columns.pollutants, *columns.weather) if c in df.columns]
    filled = forward_fill_zero(built, sources, columns.keys) if causal else interpolate(built, sources, columns.keys)
    return drop_nulls(filled, ["pollen_30day"])


def with_z_spike(df: DataFrame, columns: Columns, split: str = "split") -> DataFrame:
    """Spike label from the z score of the ratio against train rows, and the asinh target."""
    z = L.z_score("ratio_1d_7d", columns.keys, split)
    spiky = L.spike_over_z("ratio_1d_7d", columns.keys, split)
    return df.withColumns({"spike_z": z, "is_spike": spiky, "target_asinh": F.asinh(columns.target)})


def harmonic_columns(date: str = "date", first_year: Column | None = None, period: float = 365.25) -> list[Column]:
    """Day-of-year harmonics 1 and 2, and years since ``first_year`` if given."""
    day = F.dayofyear(date)
    picked = []
    for h, suffix in ((1, ""), (2, "2")):
        sine, cosine = cyclic(day, period, h)
        picked += [sine.alias(f"day_sin{suffix}"), cosine.alias(f"day_cos{suffix}")]
    if first_year is not None:
        picked.append((F.year(date) - first_year).alias("year_normalized"))
    return picked


def season_only(df: DataFrame, first: int = 3, last: int = 10, date: str = "date") -> DataFrame:
    return df.filter(F.month(date).between(first, last))
