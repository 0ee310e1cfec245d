"""Scalar column functions: calendar parts, cyclic encoding, bands, bins and transforms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (inclusive) of air quality bands 0-3; anything else is band 4.
AQI_BAND_LIMITS = [50, 100, 150, 200]
# A count below 1 is level 0; then upper bounds (inclusive) of levels 1-3, else level 4.
POLLEN_LEVEL_LIMITS = {"tree": [14, 89, 1499], "weed": [9, 49, 499], "grass": [4, 19, 199]}
# Bin edges for daily and for cumulated precipitation.
RAIN_EDGES = [0, 1, 5, 10, 20, 100]
RAIN_SUM_EDGES = [0, 1, 5, 10, 20, 50, 100]


def to_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def calendar_parts(date: Column | str) -> dict[str, Column]:
    """year, month, day, day of year, ISO week, weekday (Monday 0), weekday name, weekend flag."""
    d = to_col(date)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "weekday": F.weekday(d),
        "weekday_name": F.date_format(d, "EEEE"),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
    }


def cyclic(x: Column | str, period: float, harmonic: int = 1) -> tuple[Column, Column]:
    """Sine and cosine of a position within a period; ``harmonic`` 2 doubles the frequency."""
    angle = F.lit(2 * math.pi * harmonic) * to_col(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def season_code(month: Column | str) -> Column:
    """Season 1-4 with December to February as 1."""
    return F.floor((to_col(month) % 12 + 3) / 3).cast("int")


def aqi_band(x: Column | str) -> Column:
    """Air quality band 0-4; null and NaN count as the top band."""
    value = to_col(x)
    band = F.lit(len(AQI_BAND_LIMITS))
    for code in reversed(range(len(AQI_BAND_LIMITS))):
        band = F.when(value <= AQI_BAND_LIMITS[code], code).otherwise(band)
    return band


def pollen_level(x: Column | str, kind: str) -> Column:
    """Pollen level 0-4 by the thresholds of one pollen type; null counts as the top level."""
    value = to_col(x)
    limits = POLLEN_LEVEL_LIMITS[kind]
    level = F.lit(len(limits) + 1)
    for code in reversed(range(len(limits))):
        level = F.when(value <= limits[code], code + 1).otherwise(level)
    return F.when(value < 1, 0).otherwise(level)


def bin_index(x: Column | str, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """0-based bin by right-closed edges; null below or at the first edge and above the last one."""
    value = to_col(x)
    found = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        above = value >= edges[i] if include_lowest and i == 0 else value > edges[i]
        found = F.when(above & (value <= edges[i + 1]), i).otherwise(found)
    return found


def bin_label(x: Column | str, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """The bin as text, for example ``(0, 1]``."""
    labels = F.array(*[F.lit(f"({lo}, {hi}]") for lo, hi in zip(edges, edges[1:])])
    return F.get(labels, bin_index(x, edges, include_lowest))


def winsorize(x: Column | str, cap: Column) -> Column:
    """Upper clip that keeps nulls."""
    value = to_col(x)
    return F.when(value > cap, cap).otherwise(value)


def flag(condition: Column) -> Column:
    """0/1 from a condition; an unknown condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column | str, denominator: Column | str, epsilon: float = 0.0) -> Column:
    """Division that gives null for a zero denominator; ``epsilon`` is added to the denominator."""
    bottom = to_col(denominator) + F.lit(epsilon) if epsilon else to_col(denominator)
    return F.try_divide(to_col(numerator), bottom)


def _keyed_draw(keys: Sequence[Column | str], seed: int, place: int) -> Column:
    """A whole number below 2^52 that depends on key and seed alone: 13 hex digits of an md5."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(to_col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1 + 13 * place, 13), 16, 10).cast("bigint")


def uniform_noise(keys: Sequence[Column | str], seed: int) -> Column:
    """Noise in [0, 1) from the row's key, so the same row has the same noise however the rows lie."""
    return _keyed_draw(keys, seed, 0) / F.lit(float(1 << 52))


def normal_noise(keys: Sequence[Column | str], seed: int) -> Column:
    """Standard normal noise from the row's key (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.ln((_keyed_draw(keys, seed, 0) + 1) / F.lit(float(1 << 52))))
    return radius * F.cos(F.lit(2 * math.pi) * _keyed_draw(keys, seed, 1) / F.lit(float(1 << 52)))


def jitter(x: Column | str, keys: Sequence[Column | str], seed: int, width: float = 0.01) -> Column:
    """Add uniform noise from [0, width)."""
    return to_col(x) + uniform_noise(keys, seed) * F.lit(width)


def jitter_normal(x: Column | str, keys: Sequence[Column | str], seed: int, sd: float = 0.1) -> Column:
    """Add normal noise."""
    return to_col(x) + normal_noise(keys, seed) * F.lit(sd)


def back_in_time(date: Column | str, years: int = 0, days: int = 0) -> Column:
    """Shift a date back; 29 February becomes 28 February where needed."""
    return F.date_sub(F.add_months(to_col(date), -12 * years), days)


def nan_to_null(x: Column | str) -> Column:
    value = to_col(x)
    return F.when(~F.isnan(value), value)


def clean_text(x: Column | str) -> Column:
    """Trim, lower, and replace spaces and slashes by underscores."""
    return F.replace(F.replace(F.lower(F.trim(to_col(x))), F.lit(" "), F.lit("_")), F.lit("/"), F.lit("_"))
