"""Window features, spike labels and complete feature sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from tidemark.catalog.base import QUERIES, SQL, big, daily_sql, query, r, rounded
from tidemark.functions.scalars import flag
from tidemark.operators import labels as L
from tidemark.operators import splits as P
from tidemark.operators import windows as W
from tidemark.operators.clean import drop_nulls
from tidemark.operators.stats import describe
from tidemark.plans import features as X
from tidemark.plans.features import AIR, POLLEN
from tidemark.sources import daily
from tidemark.sources.daily import sql_gaps, with_gaps

KEYS = ["site", "date"]
SITE_AIR = X.Columns(keys=("site",), target=AIR.target, pairs=AIR.pairs)
SITE_POLLEN = X.Columns(keys=("site",), pairs=POLLEN.pairs)
SERIES = "PARTITION BY site ORDER BY date"
GAPPY = "gappy AS (" + sql_gaps("air_weather", "site date aqi pm25 o3 temp rain") + ")"


def site_window() -> WindowSpec:
    return W.series_window(["site"])


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    return with_gaps(daily.air_weather(spark, folder).select(*KEYS, "aqi", "pm25", "o3", "temp", "rain"))


# ---- SQL fragments ---------------------------------------------------------------------------


def s_lag(c: str, k: int, series: str = SERIES) -> str:
    return f"lag({c}, {k}) OVER ({series})"


def s_roll(c: str, n: int, strict: bool = True, series: str = SERIES) -> str:
    frame = f"OVER ({series} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({c}) {frame} = {n} THEN avg({c}) {frame} END" if strict else f"avg({c}) {frame}"


def s_last(c: str, k: int) -> str:
    upto = "CURRENT ROW" if k == 0 else f"{k} PRECEDING"
    return f"last_value({c} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND {upto})"


def s_round(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def s_cycle(name: str, x: str, period: float, fn: str) -> str:
    return f"round({fn}(2 * pi() * {x} / {period}), 6) AS {name}_{fn}"


def s_season(period: float, weekday: bool = False, month: bool = True) -> list[str]:
    cycles = [("day", "dayofyear(date)", period)]
    if month:
        cycles.append(("month", "month(date)", 12))
    if weekday:
        cycles.append(("weekday", "(isodow(date) - 1)", 7))
    return [s_cycle(n, x, p, fn) for n, x, p in cycles for fn in ("sin", "cos")]


def rounded_doubles(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    return rounded(df, 6, *[n for n, t in df.dtypes if t == "double" and n not in skip])


# ---- single operators ------------------------------------------------------------------------

LAGS = [1, 2, 3, 4, 7, 14, 21, 30, 365]


@query(
    "lag_features",
    daily_sql("SELECT site, date, " + ", ".join(f"{s_lag('aqi', k)} AS aqi_lag{k}" for k in LAGS) + " FROM air"),
)
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    return daily.air(spark, folder).select(*KEYS, *W.lags("aqi", LAGS, site_window()))


ROLLS = [2, 3, 7, 14, 30]


def _rolling(strict: bool):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return rounded_doubles(gappy(spark, folder).select(*KEYS, *W.rolling_means("pm25", ROLLS, site_window(), strict)))

    return build


for _strict in (True, False):
    _picked = ", ".join(s_round(s_roll("pm25", n, _strict), f"pm25_roll{n}") for n in ROLLS)
    _name = "rolling_mean_strict" if _strict else "rolling_mean_relaxed"
    query(_name, daily_sql(f"SELECT site, date, {_picked} FROM gappy", GAPPY))(_rolling(_strict))


def s_sum(c: str, k: int) -> str:
    frame = f"OVER ({SERIES} ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) {frame} = {k + 1} THEN sum({c}) {frame} END"


@query(
    "rolling_sum",
    daily_sql("SELECT site, date, " + ", ".join(s_round(s_sum("rain", k), f"rain_sum{k}") for k in range(4)) + " FROM gappy", GAPPY),
)
def rolling_sum(spark: SparkSession, folder: str) -> DataFrame:
    sums = [W.rolling_sum("rain", k, site_window()).alias(f"rain_sum{k}") for k in range(4)]
    return rounded_doubles(gappy(spark, folder).select(*KEYS, *sums))


@query(
    "lag_diff",
    daily_sql(
        f"SELECT site, date, {s_round(s_lag('aqi', 1) + ' - ' + s_lag('aqi', 2), 'diff2')}, "
        f"{s_round(s_lag('aqi', 1) + ' - ' + s_lag('aqi', 7), 'diff7')} FROM air"
    ),
)
def lag_diff(spark: SparkSession, folder: str) -> DataFrame:
    return daily.air(spark, folder).select(
        *KEYS, r(W.lag_diff("aqi", 1, 2, site_window()), "diff2"), r(W.lag_diff("aqi", 1, 7, site_window()), "diff7")
    )


@query(
    "lag_ffill",
    daily_sql(
        "SELECT site, date, "
        + ", ".join(f"{s_last('pm25', k)} AS lag{k}" for k in (1, 2, 3))
        + f", round({s_last('roll3', 0)}, 6) AS roll3 FROM (SELECT *, {s_roll('pm25', 3)} AS roll3 FROM gappy)",
        GAPPY,
    ),
)
def lag_ffill(spark: SparkSession, folder: str) -> DataFrame:
    lagged = [W.lag_filled("pm25", k, site_window()).alias(f"lag{k}") for k in (1, 2, 3)]
    built = gappy(spark, folder).select(*KEYS, *lagged, W.rolling_mean("pm25", 3, site_window()).alias("_roll3"))
    return built.select(*KEYS, "lag1", "lag2", "lag3", r(W.forward_filled("_roll3", site_window()), "roll3"))


@query(
    "weighted3_past",
    daily_sql(
        f"SELECT site, date, {s_round('0.1::DOUBLE * ' + s_last('pm25', 3) + ' + 0.3::DOUBLE * ' + s_last('pm25', 2) + ' + 0.6::DOUBLE * ' + s_last('pm25', 1), 'pm25_weighted3')} FROM gappy",
        GAPPY,
    ),
)
def weighted3_past(spark: SparkSession, folder: str) -> DataFrame:
    return gappy(spark, folder).select(*KEYS, r(W.weighted_past("pm25", site_window()), "pm25_weighted3"))


@query(
    "weighted3_current",
    daily_sql(
        f"SELECT site, date, {s_round('0.1::DOUBLE * ' + s_lag('pm25', 2) + ' + 0.3::DOUBLE * ' + s_lag('pm25', 1) + ' + 0.6::DOUBLE * pm25', 'pm25_weighted3')} FROM gappy",
        GAPPY,
    ),
)
def weighted3_current(spark: SparkSession, folder: str) -> DataFrame:
    return gappy(spark, folder).select(*KEYS, r(W.weighted_current("pm25", site_window()), "pm25_weighted3"))


@query(
    "lag_pct_change",
    daily_sql(
        "SELECT site, date, "
        + ", ".join(s_round(f"(l1 - l{k}) / nullif(l{k}, 0)", f"pct{k}") for k in (2, 7, 30))
        + ", CAST(NULL AS DOUBLE) AS pct1 FROM (SELECT site, date, "
        + ", ".join(f"{s_lag('total', k)} AS l{k}" for k in (1, 2, 7, 30))
        + " FROM pollen)"
    ),
)
def lag_pct_change(spark: SparkSession, folder: str) -> DataFrame:
    changes = [W.pct_change("total", k, site_window()).alias(f"pct{k}") for k in (1, 2, 7, 30)]
    return rounded_doubles(daily.pollen(spark, folder).select(*KEYS, *changes))


@query(
    "spike_ratio",
    daily_sql(
        f"SELECT site, date, {s_round(s_lag('total', 1) + ' / nullif(' + s_roll('total', 7) + ', 0)', 'ratio')}, "
        f"{s_round(s_lag('total', 1) + ' / (' + s_roll('total', 7, False) + ' + 1e-8)', 'ratio_eps')} FROM pollen"
    ),
)
def spike_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return daily.pollen(spark, folder).select(
        *KEYS,
        r(W.spike_ratio("total", site_window()), "ratio"),
        r(W.spike_ratio("total", site_window(), strict=False, epsilon=L.Z_EPSILON), "ratio_eps"),
    )


@query(
    "weather_yesterday",
    daily_sql(
        "SELECT site, date, "
        + ", ".join(
            f"{s_lag(c, 1)} AS {c}_yesterday, "
            + ", ".join(s_round(s_roll(c, n, False), f"{c}_yesterday_{n}day") for n in (3, 7))
            for c in ("temp", "rain")
        )
        + " FROM gappy",
        GAPPY,
    ),
)
def weather_yesterday(spark: SparkSession, folder: str) -> DataFrame:
    df = gappy(spark, folder).select(*KEYS, *W.yesterday(["temp", "rain"], site_window()))
    return rounded_doubles(df, ["temp_yesterday", "rain_yesterday"])


def s_per_type(ks: list[int], ns: list[int]) -> str:
    picked = []
    for c in ("tree", "grass", "weed"):
        picked += [s_round(s_roll(c, n), f"{c}_roll_{n}day") for n in ns]
        picked += [f"{s_lag(c, k)} AS {c}_lag_{k}" for k in ks]
        picked.append(s_round(f"{s_lag(c, 1)} / nullif({s_roll(c, 7)}, 0)", f"{c}_ratio_1d_7d"))
    return ", ".join(picked)


@query("multi_target_features", daily_sql(f"SELECT site, date, {s_per_type([1, 7, 30], [2, 7])} FROM pollen"))
def multi_target_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_doubles(
        daily.pollen(spark, folder).select(*KEYS, *W.per_target(["tree", "grass", "weed"], site_window(), [1, 7, 30], [2, 7]))
    )


@query(
    "season_lags",
    daily_sql(
        "SELECT * FROM (SELECT site, date, total, "
        + ", ".join(f"{s_lag('rain', k)} AS rain_lag{k}" if k else "rain AS rain_lag0" for k in range(4))
        + " FROM all_three WHERE month(date) BETWEEN 3 AND 9) WHERE rain_lag3 IS NOT NULL"
    ),
)
def season_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Lags inside a season-filtered frame run by row: the first day of March follows September."""
    season = X.season_only(daily.all_three(spark, folder).select(*KEYS, "total", "rain"), 3, 9)
    lagged = season.select(*KEYS, "total", F.col("rain").alias("rain_lag0"), *W.lags("rain", [1, 2, 3], site_window()))
    return drop_nulls(lagged)


@query(
    "season_lags_calendar",
    daily_sql(
        f"""
SELECT * FROM (SELECT site, date, total, {s_lag('rain', 1)} AS rain_lag1, {s_lag('rain', 7)} AS rain_lag7
  FROM (SELECT s.site, CAST(d.date AS DATE) AS date, total, rain FROM
        (SELECT site, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date FROM season GROUP BY site) d
        JOIN (SELECT DISTINCT site FROM season) s USING (site) LEFT JOIN season USING (site, date)))
WHERE total IS NOT NULL
""",
        "season AS (SELECT site, date, total, rain FROM all_three WHERE month(date) BETWEEN 3 AND 9)",
    ),
)
def season_lags_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The same by day: on a full calendar, 1 March has no value the day before."""
    season = X.season_only(daily.all_three(spark, folder).select(*KEYS, "total", "rain"), 3, 9)
    full = W.on_calendar(season, ["site"])
    return full.select(*KEYS, "total", *W.lags("rain", [1, 7], site_window())).filter(F.col("total").isNotNull())


# ---- spike labels ----------------------------------------------------------------------------

POLLEN_SPLIT = (
    "parts AS (SELECT site, date, total, CASE WHEN year(date) >= 2000 THEN 'test' WHEN year(date) = 1999 THEN 'val' "
    f"ELSE 'train' END AS split, {s_lag('total', 1)} AS lag1, {s_roll('total', 3)} AS roll3, "
    f"{s_lag('total', 1)} / nullif({s_roll('total', 7)}, 0) AS ratio FROM pollen)"
)


def pollen_parts(spark: SparkSession, folder: str) -> DataFrame:
    df = daily.pollen(spark, folder).select(*KEYS, "total")
    return P.split_by_year(df, 2000, val_year=1999).select(
        "*",
        W.lag("total", 1, site_window()).alias("lag1"),
        W.rolling_mean("total", 3, site_window()).alias("roll3"),
        W.spike_ratio("total", site_window()).alias("ratio"),
    )


@query(
    "spike_threshold",
    daily_sql(
        "SELECT site, round(CASE WHEN count(*) >= 5 THEN avg(total) ELSE median(total) END + stddev_samp(total), 6) AS threshold "
        "FROM parts WHERE split = 'train' GROUP BY site",
        POLLEN_SPLIT,
    ),
)
def spike_threshold(spark: SparkSession, folder: str) -> DataFrame:
    limit = L.mean_std_threshold("total", ["site"])
    parts = pollen_parts(spark, folder).select("site", "total", "split").withColumn("threshold", limit)
    return parts.groupBy("site").agg(r(F.max("threshold"), "threshold"))


@query(
    "spike_flag_meanstd",
    daily_sql(
        "SELECT p.site, p.date, CAST(coalesce(lag1 > threshold, false) AS INTEGER) AS is_spike FROM parts p JOIN "
        "(SELECT site, avg(total) + stddev_samp(total) AS threshold FROM parts WHERE split = 'train' GROUP BY site) USING (site)",
        POLLEN_SPLIT,
    ),
)
def spike_flag_meanstd(spark: SparkSession, folder: str) -> DataFrame:
    spiky = L.spike_over_threshold("lag1", L.mean_std_threshold("total", ["site"]))
    return pollen_parts(spark, folder).select(*KEYS, spiky.alias("is_spike"))


def s_flag_quantile(value: str, column: str, q: float, where: str) -> str:
    return daily_sql(
        f"SELECT p.site, p.date, CAST(coalesce({value} > threshold, false) AS INTEGER) AS is_spike FROM parts p JOIN "
        f"(SELECT site, quantile_cont({column}, {q}) AS threshold FROM parts {where} GROUP BY site) USING (site)",
        POLLEN_SPLIT,
    )


@query("spike_flag_q75", s_flag_quantile("lag1 - roll3", "roll3", 0.75, "WHERE split = 'train'"))
def spike_flag_q75(spark: SparkSession, folder: str) -> DataFrame:
    return pollen_parts(spark, folder).select(*KEYS, L.spike_over_jump("lag1", "roll3", ["site"]).alias("is_spike"))


@query("spike_flag_q75_all_rows", s_flag_quantile("lag1 - roll3", "roll3", 0.75, ""))
def spike_flag_q75_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold over all rows looks into the future; kept for comparison."""
    spiky = L.spike_over_jump("lag1", "roll3", ["site"], split=None)
    return pollen_parts(spark, folder).select(*KEYS, spiky.alias("is_spike"))


@query("spike_flag_q95", s_flag_quantile("ratio", "ratio", 0.95, "WHERE split = 'train'"))
def spike_flag_q95(spark: SparkSession, folder: str) -> DataFrame:
    spiky = flag(F.col("ratio") > L.train_quantile("ratio", 0.95, ["site"]))
    return pollen_parts(spark, folder).select(*KEYS, spiky.alias("is_spike"))


@query(
    "spike_flag_roll",
    daily_sql("SELECT site, date, CAST(coalesce(lag1 > roll3, false) AS INTEGER) AS is_spike FROM parts", POLLEN_SPLIT),
)
def spike_flag_roll(spark: SparkSession, folder: str) -> DataFrame:
    return pollen_parts(spark, folder).select(*KEYS, L.spike_over_roll("lag1", "roll3").alias("is_spike"))


@query(
    "spike_flag_z",
    daily_sql(
        "SELECT p.site, p.date, round((ratio - m) / (s + 1e-8), 6) AS z, "
        "CAST(coalesce((ratio - m) / (s + 1e-8) > 1.64, false) AS INTEGER) AS is_spike FROM parts p JOIN "
        "(SELECT site, avg(ratio) AS m, stddev_pop(ratio) AS s FROM parts WHERE split = 'train' GROUP BY site) USING (site)",
        POLLEN_SPLIT,
    ),
)
def spike_flag_z(spark: SparkSession, folder: str) -> DataFrame:
    return pollen_parts(spark, folder).select(
        *KEYS, r(L.z_score("ratio", ["site"]), "z"), L.spike_over_z("ratio", ["site"]).alias("is_spike")
    )


@query(
    "spike_weight",
    daily_sql(
        "SELECT site, date, CASE WHEN lag1 > roll3 THEN 10::DOUBLE ELSE 1::DOUBLE END AS weight FROM parts",
        POLLEN_SPLIT,
    ),
)
def spike_weight(spark: SparkSession, folder: str) -> DataFrame:
    flagged = pollen_parts(spark, folder).withColumn("is_spike", L.spike_over_roll("lag1", "roll3"))
    return flagged.select(*KEYS, L.spike_weight().alias("weight"))


@query(
    "winsorize",
    daily_sql(
        "SELECT p.site, p.date, round(least(total, cap), 6) AS capped, round(ln(1 + least(total, cap)), 6) AS log_total FROM parts p "
        "JOIN (SELECT site, quantile_cont(total, 0.99) AS cap FROM parts WHERE split = 'train' GROUP BY site) USING (site)",
        POLLEN_SPLIT,
    ),
)
def winsorize(spark: SparkSession, folder: str) -> DataFrame:
    parts = L.with_log_target(pollen_parts(spark, folder).select(*KEYS, "total", "split"), "total", ["site"])
    return parts.select(*KEYS, r("total_capped", "capped"), r("log_total", "log_total"))


# ---- complete feature sets -------------------------------------------------------------------


def s_aqi_features(series: str) -> str:
    picked = [f"{s_lag('aqi', k, series)} AS aqi_lag{k}" for k in (2, 3)]
    picked += [s_round(s_roll("aqi", n, True, series), f"aqi_roll{n}") for n in (3, 7)]
    picked += [s_round(f"{s_lag('aqi', 1, series)} - {s_lag('aqi', k, series)}", f"aqi_diff{k}") for k in (2, 7)]
    for p in AIR.pollutants:
        picked += [f"{s_lag(p, k, series)} AS {p}_lag{k}" for k in (1, 3, 7)]
        picked += [s_round(s_roll(p, n, True, series), f"{p}_roll{n}") for n in (3, 7)]
    for c in AIR.weather:
        picked.append(f"{s_lag(c, 1, series)} AS {c}_lag1")
        picked += [s_round(s_roll(c, n, True, series), f"{c}_roll{n}") for n in (3, 7)]
    picked += [s_round(f"{s_lag(a, 1, series)} * {s_lag(b, 1, series)}", f"{a}_{b}") for a, b in AIR.pairs]
    picked += ["month(date) AS month", "dayofyear(date) AS day_of_year", "isodow(date) - 1 AS weekday"]
    picked += ["CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend", *s_season(365, weekday=True)]
    return ", ".join(picked)


JOINED_SPLIT = """joined AS (SELECT *, CASE WHEN date >= newest - INTERVAL 1 YEAR THEN 'test'
    WHEN date >= newest - INTERVAL 1 YEAR - INTERVAL 1 YEAR THEN 'val' ELSE 'train' END AS split
  FROM air_weather, (SELECT max(date) AS newest FROM air_weather))"""


def _aqi_sql(series: str) -> str:
    return daily_sql(
        f"SELECT * FROM (SELECT site, date, aqi, split, {s_aqi_features(series)} FROM joined) "
        "WHERE aqi_roll7 IS NOT NULL AND aqi_diff7 IS NOT NULL",
        JOINED_SPLIT,
    )


CALENDAR_INTS = ["month", "day_of_year", "weekday", "is_weekend"]


def aqi_table(spark: SparkSession, folder: str, within_split: bool = False) -> DataFrame:
    parts = P.split_relative(daily.stored(daily.air_weather(spark, folder)))
    return X.aqi_features(parts, SITE_AIR, within_split)


def tidy(df: DataFrame) -> DataFrame:
    whole = [c for c in CALENDAR_INTS if c in df.columns]
    exact = [c for c in df.columns if "_lag" in c and not c.endswith("_pct")] + ["aqi", "total"]
    return big(rounded_doubles(df, exact), *whole)


@query("aqi_features", _aqi_sql(SERIES))
def aqi_features(spark: SparkSession, folder: str) -> DataFrame:
    """Build on the whole series, then split."""
    return tidy(aqi_table(spark, folder))


@query("features_by_split", _aqi_sql("PARTITION BY site, split ORDER BY date"))
def features_by_split(spark: SparkSession, folder: str) -> DataFrame:
    """Split first, then build: each split loses its first 7 rows."""
    return tidy(aqi_table(spark, folder, within_split=True))


POLLEN_LOG_SQL = daily_sql(
    "SELECT site, date, total, split, "
    + ", ".join(f"lag_{k}" for k in X.LONG_LAGS)
    + ", "
    + ", ".join(s_round(f"pollen_{n}day", f"pollen_{n}day") for n in X.LONG_ROLLS)
    + ", day_sin, day_cos, month_sin, month_cos, round(b.ratio_1d_7d, 6) AS ratio_1d_7d, "
    "CAST(coalesce(b.ratio_1d_7d > thr, false) AS INTEGER) AS is_spike, round(least(total, cap), 6) AS total_capped, "
    "round(ln(1 + least(total, cap)), 6) AS log_total, CASE WHEN b.ratio_1d_7d > thr THEN 10::DOUBLE ELSE 1::DOUBLE END AS weight "
    "FROM built b JOIN (SELECT site, quantile_cont(ratio_1d_7d, 0.95) AS thr, quantile_cont(total, 0.99) AS cap "
    "FROM built WHERE split = 'train' GROUP BY site) USING (site)",
    "built AS (SELECT * FROM (SELECT site, date, total, CASE WHEN year(date) >= 2000 THEN 'test' WHEN year(date) = 1999 THEN 'val' "
    "ELSE 'train' END AS split, "
    + ", ".join(f"{s_lag('total', k)} AS lag_{k}" for k in X.LONG_LAGS)
    + ", "
    + ", ".join(f"{s_roll('total', n)} AS pollen_{n}day" for n in X.LONG_ROLLS)
    + f", {', '.join(s_season(365))}, {s_lag('total', 1)} / nullif({s_roll('total', 7)}, 0) AS ratio_1d_7d FROM pollen "
    "WHERE month(date) BETWEEN 3 AND 10) WHERE pollen_30day IS NOT NULL)",
)


def pollen_log_table(spark: SparkSession, folder: str) -> DataFrame:
    season = X.season_only(daily.pollen(spark, folder).select(*KEYS, "total"))
    return X.pollen_log(P.split_by_year(season, 2000, val_year=1999), SITE_POLLEN)


@query("pollen_features", POLLEN_LOG_SQL)
def pollen_features(spark: SparkSession, folder: str) -> DataFrame:
    """Season rows only, log target: lags and strict means to 30 days, ratio, spike and weight."""
    return tidy(pollen_log_table(spark, folder))


@query(
    "pollen_features_per_type",
    daily_sql(
        f"SELECT * FROM (SELECT *, {', '.join(s_season(365))}, {s_per_type(X.LONG_LAGS, [2, 7, 30])} FROM pollen) "
        "WHERE tree_roll_30day IS NOT NULL"
    ),
)
def pollen_features_per_type(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(X.pollen_per_type(daily.pollen(spark, folder), SITE_POLLEN))


BASIC_COLS = [*POLLEN.weather, *POLLEN.pollutants]


@query(
    "pollen_features_basic",
    daily_sql(
        "SELECT site, date, total, split, lag1, lag2, lag3, round(pollen_3day, 6) AS pollen_3day, round(pollen_7day, 6) AS pollen_7day, "
        "day_sin, day_cos, temp_x_aqi, apparent_x_pm25, wind_x_o3, "
        + ", ".join(f"{c}_weighted3, {c}_lag1, {c}_lag2, {c}_lag3" for c in BASIC_COLS)
        + ", CAST(coalesce(lag1 > thr, false) AS INTEGER) AS is_spike FROM built JOIN "
        "(SELECT site, avg(total) + stddev_samp(total) AS thr FROM built WHERE split = 'train' GROUP BY site) USING (site) "
        "WHERE lag3 IS NOT NULL",
        "built AS (SELECT site, date, total, CASE WHEN year(date) >= 2000 THEN 'test' ELSE 'train' END AS split, "
        + ", ".join(f"{s_lag('total', k)} AS lag{k}" for k in (1, 2, 3))
        + ", "
        + ", ".join(f"{s_roll('total', n, False)} AS pollen_{n}day" for n in (3, 7))
        + ", "
        + ", ".join(s_season(365, month=False))
        + ", round(temp * aqi, 6) AS temp_x_aqi, round(apparent * pm25, 6) AS apparent_x_pm25, round(wind * o3, 6) AS wind_x_o3, "
        + ", ".join(
            s_round(f"0.1::DOUBLE * {s_lag(c, 2)} + 0.3::DOUBLE * {s_lag(c, 1)} + 0.6::DOUBLE * {c}", f"{c}_weighted3")
            + ", "
            + ", ".join(f"{s_lag(c, k)} AS {c}_lag{k}" for k in (1, 2, 3))
            for c in BASIC_COLS
        )
        + " FROM all_three)",
    ),
)
def pollen_features_basic(spark: SparkSession, folder: str) -> DataFrame:
    built = X.pollen_basic(P.split_by_year(daily.all_three(spark, folder), 2000), SITE_POLLEN)
    sources = ["aqi", *POLLEN.pollutants, *POLLEN.weather, "gust", "apparent", "wind_dir", *POLLEN.types]
    return tidy(built.drop(*sources))


PAST_COLS = ["temp", *POLLEN.pollutants]


@query(
    "pollen_features_past_only",
    daily_sql(
        "SELECT site, date, total, lag1, lag2, lag3, round(pollen_3day, 6) AS pollen_3day, round(pollen_7day, 6) AS pollen_7day, "
        "CAST(lag1 > pollen_3day AS INTEGER) AS is_spike, day_sin, day_cos, "
        + ", ".join(f"{c}_weighted3, {c}_lag1, {c}_lag2, {c}_lag3" for c in PAST_COLS)
        + " FROM (SELECT *, "
        + ", ".join(f"{s_last(f'r{n}', 0)} AS pollen_{n}day" for n in (3, 7))
        + " FROM raw) WHERE lag3 IS NOT NULL AND pollen_7day IS NOT NULL",
        "gap3 AS (" + sql_gaps("all_three", "site date total temp pm25 o3 co no2 so2") + ")",
        "raw AS (SELECT site, date, total, "
        + ", ".join(f"{s_last('total', k)} AS lag{k}" for k in (1, 2, 3))
        + ", "
        + ", ".join(f"{s_roll('total', n)} AS r{n}" for n in (3, 7))
        + ", "
        + ", ".join(s_season(365, month=False))
        + ", "
        + ", ".join(
            s_round(f"0.1::DOUBLE * {s_last(c, 3)} + 0.3::DOUBLE * {s_last(c, 2)} + 0.6::DOUBLE * {s_last(c, 1)}", f"{c}_weighted3")
            + ", "
            + ", ".join(f"{s_last(c, k)} AS {c}_lag{k}" for k in (1, 2, 3))
            for c in PAST_COLS
        )
        + " FROM gap3)",
    ),
)
def pollen_features_past_only(spark: SparkSession, folder: str) -> DataFrame:
    """On a table with missing values: lags and rolling means carry the last known value."""
    source = with_gaps(daily.all_three(spark, folder).select(*KEYS, "total", *PAST_COLS))
    built = X.pollen_past_only(source, SITE_POLLEN)
    return tidy(built.drop(*PAST_COLS))


TWO_STAGE_KS = [*X.LONG_LAGS, 365]


def two_stage_table(spark: SparkSession, folder: str, year_lag: bool = True, causal: bool = False) -> DataFrame:
    """Z-spike labels come from the ratio, so the ratio is no feature later on. ``causal``: a table with
    missing values, filled forward."""
    source = daily.all_three(spark, folder).select(*KEYS, "total", *POLLEN.weather)
    columns = X.Columns(keys=("site",), pollutants=())
    built = X.pollen_two_stage(with_gaps(source) if causal else source, columns, year_lag, causal)
    return X.with_z_spike(P.split_by_year(built, 2000, val_year=1999), columns)


def two_stage_sql(source: str, sources: str, *tables: str) -> str:
    return daily_sql(
        "SELECT b.* REPLACE (round(ratio_1d_7d, 6) AS ratio_1d_7d), round((ratio_1d_7d - m) / (s + 1e-8), 6) AS spike_z, "
        "CAST(coalesce((ratio_1d_7d - m) / (s + 1e-8) > 1.64, false) AS INTEGER) AS is_spike, round(asinh(total), 6) AS target_asinh "
        "FROM built b JOIN (SELECT site, avg(ratio_1d_7d) AS m, stddev_pop(ratio_1d_7d) AS s FROM built WHERE split = 'train' "
        "GROUP BY site) USING (site)",
        *tables,
        f"built AS (SELECT * FROM (SELECT site, date, {sources}, CASE WHEN year(date) >= 2000 THEN 'test' "
        "WHEN year(date) = 1999 THEN 'val' ELSE 'train' END AS split, dayofyear(date) AS day_of_year, month(date) AS month, "
        "isodow(date) - 1 AS weekday, "
        + ", ".join(s_season(365.25, weekday=True))
        + ", "
        + ", ".join(f"{s_lag('total', k)} AS lag_{k}" for k in TWO_STAGE_KS)
        + ", "
        + ", ".join(
            s_round(f"({s_lag('total', 1)} - {s_lag('total', k)}) / nullif({s_lag('total', k)}, 0)", f"lag_{k}_pct")
            for k in TWO_STAGE_KS
            if k > 1
        )
        + ", "
        + ", ".join(s_round(s_roll("total", n, False), f"pollen_{n}day") for n in X.LONG_ROLLS)
        + f", {s_lag('total', 1)} / ({s_roll('total', 7, False)} + 1e-8) AS ratio_1d_7d, "
        + ", ".join(
            f"{s_lag(c, 1)} AS {c}_yesterday, "
            + ", ".join(s_round(s_roll(c, n, False), f"{c}_yesterday_{n}day") for n in (3, 7))
            for c in POLLEN.weather
        )
        + f" FROM {source}) WHERE pollen_30day IS NOT NULL)",
    )


def tidy_two_stage(df: DataFrame) -> DataFrame:
    exact = ["total", "temp", "wind", "rain"]
    return big(rounded_doubles(df, exact), "day_of_year", "month", "weekday")


@query("pollen_features_two_stage", two_stage_sql("all_three", "total, temp, wind, rain"))
def pollen_features_two_stage(spark: SparkSession, folder: str) -> DataFrame:
    return tidy_two_stage(two_stage_table(spark, folder))


FILLED_FORWARD = ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY site ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {c}"
    for c in ("total", "temp", "wind", "rain")
)


@query(
    "pollen_features_two_stage_causal",
    two_stage_sql("gap4", FILLED_FORWARD, f"gap4 AS ({sql_gaps('all_three', 'site date total temp wind rain')})"),
)
def pollen_features_two_stage_causal(spark: SparkSession, folder: str) -> DataFrame:
    """The same set on a table with missing values, each gap filled by the last known value."""
    return tidy_two_stage(two_stage_table(spark, folder, causal=True))


@query(
    "feature_describe",
    daily_sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS q50 FROM f"
            for c in ("aqi_lag2", "aqi_roll7")
        ),
        JOINED_SPLIT,
        f"f AS (SELECT * FROM (SELECT {s_lag('aqi', 2)} AS aqi_lag2, {s_roll('aqi', 7)} AS aqi_roll7 FROM joined) WHERE aqi_roll7 IS NOT NULL)",
    ),
)
def feature_describe(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of built features."""
    built = daily.stored(aqi_table(spark, folder).select("aqi_lag2", "aqi_roll7"))
    summary = describe(built, ["aqi_lag2", "aqi_roll7"])
    return summary.select("variable", F.col("count").alias("n"), r("mean", "mean"), r("q50", "q50"))


@query(
    "feature_describe_all",
    "WITH f AS (" + SQL["aqi_features"] + """)
SELECT variable, count(value) AS n, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std, round(min(value), 5) AS min,
  round(quantile_cont(value, 0.25), 5) AS q25, round(quantile_cont(value, 0.5), 5) AS q50, round(quantile_cont(value, 0.75), 5) AS q75,
  round(max(value), 5) AS max
FROM (UNPIVOT (SELECT COLUMNS(* EXCLUDE (site, date, split))::DOUBLE FROM f) ON COLUMNS(*) INTO NAME variable VALUE value) GROUP BY variable""",
)
def feature_describe_all(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of every column of the air quality feature table."""
    built = daily.stored(QUERIES["aqi_features"](spark, folder).drop("site", "date", "split"))
    summary = describe(built, built.columns)
    return summary.select("variable", F.col("count").alias("n"), *[r(c, c, 5) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])
