"""Projections, filters, null handling, joins, splits, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import big, daily_sql, query, r, rounded
from tidemark.functions import names as N
from tidemark.functions import scalars as S
from tidemark.operators import clean as C
from tidemark.operators import joins as J
from tidemark.operators import ordering as O
from tidemark.operators import splits as P
from tidemark.operators import stats as G
from tidemark.operators import windows as W
from tidemark.plans.scalar_stats import constants
from tidemark.sources import daily
from tidemark.sources.daily import sql_gaps, with_gaps
from tidemark.sources.readers import nan_as_null, numeric_or_null, parse_date, read_table

Frame = DataFrame
KEYS = ["site", "date"]
# Unit-bearing source names of the weather columns.
RAW_NAMES = {
    "temp": "temperature_2m_mean (°C)",
    "rain": "precipitation_sum (mm)",
    "wind": "wind_speed_10m_max (km/h)",
    "gust": "wind_gusts_10m_max (km/h)",
}
TEST_FROM, VAL_YEAR = 2000, 1999  # the order dates end in 2001


# ---- names and projections -------------------------------------------------------------------


@query("rename_key", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def rename_key(spark: SparkSession, folder: str) -> Frame:
    orders = read_table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    return N.rename_key(orders).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def _raw_weather(spark: SparkSession, folder: str) -> Frame:
    return daily.weather(spark, folder).select(*KEYS, *RAW_NAMES).withColumnsRenamed(RAW_NAMES)


CLEANED = {
    "standard": ["temperature_2m_mean", "precipitation_sum", "wind_speed_10m_max_km_h", "wind_gusts_10m_max_km_h"],
    "basic": ["temperature_2m_mean_°C", "precipitation_sum_mm", "wind_speed_10m_max_km/h", "wind_gusts_10m_max_km/h"],
    "no_degree": ["temperature_2m_mean_C", "precipitation_sum_mm", "wind_speed_10m_max_km/h", "wind_gusts_10m_max_km/h"],
    "no_slash": ["temperature_2m_mean_°C", "precipitation_sum_mm", "wind_speed_10m_max_km_h", "wind_gusts_10m_max_km_h"],
}


def _cleaned_sql(style: str) -> str:
    picked = ", ".join(f'{col} AS "{name}"' for col, name in zip(RAW_NAMES, CLEANED[style]))
    return daily_sql(f"SELECT site, date, {picked} FROM weather")


def _clean_query(style: str):
    return lambda spark, folder: N.with_clean_names(_raw_weather(spark, folder), style)


query("clean_names", _cleaned_sql("standard"))(_clean_query("standard"))
for _style in ("basic", "no_degree", "no_slash"):
    query(f"clean_names_{_style}", _cleaned_sql(_style))(_clean_query(_style))


@query("select_present", daily_sql("SELECT date, aqi, so2 FROM air"))
def select_present(spark: SparkSession, folder: str) -> Frame:
    return N.select_present(daily.air(spark, folder), ["date", "aqi", "ragweed", "so2", "humidity"])


@query(
    "parse_date_coerce",
    """
SELECT o_orderkey, try_cast(txt AS DATE) AS date FROM (
  SELECT o_orderkey, CASE WHEN dayofyear(o_orderdate) % 17 = 0 THEN strftime(o_orderdate, '%Y-13-%d')
                          ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt FROM orders)
""",
)
def parse_date_coerce(spark: SparkSession, folder: str) -> Frame:
    """Dates as text, some with month 13: those become null."""
    day = F.col("o_orderdate")
    bad = F.dayofyear(day) % 17 == 0
    text = F.when(bad, F.date_format(day, "yyyy-'13'-dd")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    return read_table(spark, folder, "orders").select("o_orderkey", parse_date(text).alias("date"))


@query("parse_date_strict", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders")
def parse_date_strict(spark: SparkSession, folder: str) -> Frame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return read_table(spark, folder, "orders").select("o_orderkey", parse_date(text, strict=True).alias("date"))


@query(
    "numeric_coerce",
    """
SELECT o_orderkey, try_cast(CASE WHEN dayofyear(o_orderdate) % 19 = 0 THEN 'n/a'
                                 ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE) AS value FROM orders
""",
)
def numeric_coerce(spark: SparkSession, folder: str) -> Frame:
    text = F.when(F.dayofyear("o_orderdate") % 19 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    return read_table(spark, folder, "orders").select("o_orderkey", numeric_or_null(text).alias("value"))


@query(
    "nan_to_null",
    "SELECT l_returnflag, count(*) AS n_rows, count(nullif(l_discount, 0)) AS n_present FROM lineitem GROUP BY 1",
)
def nan_to_null(spark: SparkSession, folder: str) -> Frame:
    """0/0 as NaN stands for missing in the source; it is null after the read step."""
    with_nan = read_table(spark, folder, "lineitem").select(
        "l_returnflag", F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("x")
    )
    return nan_as_null(with_nan).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("x").alias("n_present")
    )


@query("numeric_cols", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def numeric_cols(spark: SparkSession, folder: str) -> Frame:
    customer = read_table(spark, folder, "customer")
    return customer.select(*N.numeric_columns(customer))


@query("feature_list", daily_sql("SELECT temp, rain, wind, gust, apparent, wind_dir, no2 FROM air_weather"))
def feature_list(spark: SparkSession, folder: str) -> Frame:
    joined = daily.air_weather(spark, folder)
    return joined.select(*N.feature_columns(joined, ["site", "date", "aqi", "pm25", "o3", "co", "so2"]))


@query("columns_by_pattern", daily_sql("SELECT pm25, wind, wind_dir FROM air_weather"))
def columns_by_pattern(spark: SparkSession, folder: str) -> Frame:
    joined = daily.air_weather(spark, folder)
    return joined.select(*N.columns_like(joined, ending=["25"], containing=["wind"]))


# ---- filters ---------------------------------------------------------------------------------


@query("season_filter", daily_sql("SELECT site, date, total FROM pollen WHERE month(date) BETWEEN 3 AND 10"))
def season_filter(spark: SparkSession, folder: str) -> Frame:
    return daily.pollen(spark, folder).filter(F.month("date").between(3, 10)).select(*KEYS, "total")


@query(
    "date_range_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def date_range_filter(spark: SparkSession, folder: str) -> Frame:
    """The bound is a literal of the column's own type, so it reaches the parquet scan."""
    from_day = F.lit("2000-01-01").cast("timestamp_ntz")
    return read_table(spark, folder, "orders").filter(F.col("o_orderdate") >= from_day).select("o_orderkey", "o_totalprice")


@query("year_filter", daily_sql("SELECT site, date, aqi FROM air WHERE year(date) < 2000"))
def year_filter(spark: SparkSession, folder: str) -> Frame:
    return daily.air(spark, folder).filter(F.year("date") < 2000).select(*KEYS, "aqi")


# ---- nulls -----------------------------------------------------------------------------------

GAPPY = "gappy AS (" + sql_gaps("all_three", "site date aqi pm25 o3 temp rain total") + ")"


def gappy(spark: SparkSession, folder: str) -> Frame:
    columns = [*KEYS, "aqi", "pm25", "o3", "temp", "rain", "total"]
    return with_gaps(daily.all_three(spark, folder).select(*columns))


@query("dropna_subset", daily_sql("SELECT * FROM gappy WHERE pm25 IS NOT NULL AND rain IS NOT NULL", GAPPY))
def dropna_subset(spark: SparkSession, folder: str) -> Frame:
    return C.drop_nulls(gappy(spark, folder), ["pm25", "rain"])


@query("dropna_any", daily_sql("SELECT * FROM gappy WHERE pm25 + o3 + temp + rain + total IS NOT NULL", GAPPY))
def dropna_any(spark: SparkSession, folder: str) -> Frame:
    return C.drop_nulls(gappy(spark, folder))


@query(
    "required_mask",
    daily_sql(
        "SELECT site, count(*) FILTER (WHERE pm25 + o3 + temp IS NOT NULL) AS n_kept, "
        "count(*) FILTER (WHERE pm25 + o3 + temp IS NULL) AS n_dropped FROM gappy GROUP BY site",
        GAPPY,
    ),
)
def required_mask(spark: SparkSession, folder: str) -> Frame:
    return C.count_dropped(gappy(spark, folder), ["pm25", "o3", "temp"], ["site"])


@query(
    "fill_zero",
    daily_sql("SELECT site, date, coalesce(pm25, 0) AS pm25, coalesce(rain, 0) AS rain, total FROM gappy", GAPPY),
)
def fill_zero(spark: SparkSession, folder: str) -> Frame:
    return C.fill_zero(gappy(spark, folder).select(*KEYS, "pm25", "rain", "total"), ["pm25", "rain"])


@query(
    "fill_mean",
    daily_sql(
        "SELECT site, date, round(coalesce(pm25, (SELECT avg(pm25) FROM gappy)), 6) AS pm25, "
        "round(coalesce(total, (SELECT avg(total) FROM gappy)), 6) AS total FROM gappy",
        GAPPY,
    ),
)
def fill_mean(spark: SparkSession, folder: str) -> Frame:
    table = daily.stored(gappy(spark, folder).select(*KEYS, "pm25", "total"))
    return rounded(C.fill_mean(table, ["pm25", "total"]), 6, "pm25", "total")


@query(
    "fill_mean_train",
    daily_sql(
        "SELECT site, date, round(coalesce(pm25, (SELECT avg(pm25) FROM gappy WHERE year(date) < 2000)), 6) AS pm25 "
        "FROM gappy",
        GAPPY,
    ),
)
def fill_mean_train(spark: SparkSession, folder: str) -> Frame:
    df = daily.stored(gappy(spark, folder).select(*KEYS, "pm25"))
    return rounded(C.fill_mean(df, ["pm25"], fit_on=df.filter(F.year("date") < 2000)), 6, "pm25")


@query(
    "fill_train_median",
    daily_sql(
        "SELECT site, date, CASE WHEN year(date) >= 2000 THEN 'test' ELSE 'train' END AS split, "
        + ", ".join(
            f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM gappy WHERE year(date) < 2000)), 6) AS {c}"
            for c in ("pm25", "rain", "total")
        )
        + " FROM gappy",
        GAPPY,
    ),
)
def fill_train_median(spark: SparkSession, folder: str) -> Frame:
    cols = ["pm25", "rain", "total"]
    parts = P.split_by_year(daily.stored(gappy(spark, folder).select(*KEYS, *cols)), TEST_FROM)
    return rounded(C.fill_train_median(parts, cols), 6, *cols)


@query(
    "ffill_zero",
    daily_sql(
        "SELECT site, date, "
        + ", ".join(
            f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY site ORDER BY date "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {c}"
            for c in ("pm25", "rain")
        )
        + " FROM gappy",
        GAPPY,
    ),
)
def ffill_zero(spark: SparkSession, folder: str) -> Frame:
    return C.forward_fill_zero(gappy(spark, folder).select(*KEYS, "pm25", "rain"), ["pm25", "rain"], ["site"])


@query(
    "interpolate_zero",
    daily_sql(
        """
SELECT site, date, round(coalesce(CASE
    WHEN total IS NOT NULL THEN total
    WHEN pv IS NOT NULL AND nv IS NULL THEN pv
    WHEN pv IS NOT NULL THEN pv + (nv - pv) * (rn - pr) / (nr - pr) END, 0), 6) AS total
FROM (SELECT *,
        last_value(total IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN total IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS pr,
        first_value(total IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN total IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS nr
      FROM (SELECT site, date, total, row_number() OVER (PARTITION BY site ORDER BY date) AS rn FROM gappy)
      WINDOW b AS (PARTITION BY site ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS (PARTITION BY site ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
""",
        GAPPY,
    ),
)
def interpolate_zero(spark: SparkSession, folder: str) -> Frame:
    return rounded(C.interpolate(gappy(spark, folder).select(*KEYS, "total"), ["total"], ["site"]), 6, "total")


@query(
    "constant_cols",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(min({e}) AS DOUBLE) AS min_value, CAST(max({e}) AS DOUBLE) AS max_value, "
        f"min({e}) = max({e}) AS is_constant FROM lineitem"
        for c, e in [("l_quantity", "l_quantity"), ("l_discount", "l_discount"), ("one", "1")]
    ),
)
def constant_cols(spark: SparkSession, folder: str) -> Frame:
    df = read_table(spark, folder, "lineitem").select("l_quantity", "l_discount", F.lit(1).alias("one"))
    return C.spread_of_columns(df, df.columns)


@query(
    "guards",
    daily_sql(
        """
SELECT 'null dates' AS "check", count(*) FILTER (WHERE date IS NULL) AS failures FROM air
UNION ALL SELECT 'column aqi', 0 UNION ALL SELECT 'column ragweed', 1
UNION ALL SELECT 'split train empty', CAST(count(*) FILTER (WHERE year(date) < 2000) = 0 AS BIGINT) FROM air
UNION ALL SELECT 'split test empty', CAST(count(*) FILTER (WHERE year(date) >= 2000) = 0 AS BIGINT) FROM air
"""
    ),
)
def guards(spark: SparkSession, folder: str) -> Frame:
    parts = P.split_by_year(daily.air(spark, folder), TEST_FROM)
    return C.guard_report(parts, "date", ["aqi", "ragweed"], "split", ["train", "test"])


# ---- joins -----------------------------------------------------------------------------------


@query("join_inner_daily", daily_sql("SELECT * FROM air JOIN weather USING (site, date)"))
def join_inner_daily(spark: SparkSession, folder: str) -> Frame:
    return daily.air(spark, folder).join(daily.weather(spark, folder), KEYS)


@query("join_three_way", daily_sql("SELECT * FROM pollen JOIN weather USING (site, date) JOIN air USING (site, date)"))
def join_three_way(spark: SparkSession, folder: str) -> Frame:
    return daily.all_three(spark, folder)


@query(
    "join_fold",
    daily_sql(
        "SELECT date, p.n AS n_pollen, w.n AS n_weather, a.n AS n_air "
        "FROM (SELECT date, count(*) AS n FROM pollen GROUP BY 1) p "
        "JOIN (SELECT date, count(*) AS n FROM weather GROUP BY 1) w USING (date) "
        "JOIN (SELECT date, count(*) AS n FROM air GROUP BY 1) a USING (date)"
    ),
)
def join_fold(spark: SparkSession, folder: str) -> Frame:
    """Days of each table, joined one after the other. Air and pollen are one written table, so the
    orders are scanned once."""
    both = daily.stored(daily.air_pollen(spark, folder))
    tables = {"pollen": both.select(*KEYS, "total"), "weather": daily.weather(spark, folder), "air": both.select(*KEYS, "aqi")}
    counted = [t.groupBy("date").agg(F.count(F.lit(1)).alias(f"n_{name}")) for name, t in tables.items()]
    return J.join_all(counted, ["date"])


@query(
    "join_full_outer",
    daily_sql(
        """
SELECT coalesce(a.date, w.date) AS date, a.aqi, w.temp
FROM (SELECT CASE WHEN dayofyear(date) <> 60 THEN date END AS date, max(aqi) AS aqi FROM air GROUP BY 1) a
FULL JOIN (SELECT CASE WHEN dayofyear(date) <> 61 THEN date END AS date, max(temp) AS temp FROM weather GROUP BY 1) w
  ON a.date IS NOT DISTINCT FROM w.date
"""
    ),
)
def join_full_outer(spark: SparkSession, folder: str) -> Frame:
    """Each side has one row without a date; the two are matched with each other."""

    def per_day(df: Frame, col: str, unknown_day: int) -> Frame:
        day = F.when(F.dayofyear("date") != unknown_day, F.col("date"))
        return df.groupBy(day.alias("date")).agg(F.max(col).alias(col))

    left = per_day(daily.air(spark, folder), "aqi", 60)
    return J.join_full_null_safe(left, per_day(daily.weather(spark, folder), "temp", 61), ["date"])


@query("join_left_align", daily_sql("SELECT site, date, temp, aqi FROM weather LEFT JOIN air USING (site, date)"))
def join_left_align(spark: SparkSession, folder: str) -> Frame:
    return J.align_left(
        daily.weather(spark, folder).select(*KEYS, "temp"), daily.air(spark, folder).select(*KEYS, "aqi"), KEYS
    )


@query("join_semi", daily_sql("SELECT site, date, temp FROM weather SEMI JOIN air USING (site, date)"))
def join_semi(spark: SparkSession, folder: str) -> Frame:
    return J.keep_matching(daily.weather(spark, folder).select(*KEYS, "temp"), daily.air(spark, folder), KEYS)


@query(
    "train_stats_apply",
    daily_sql(
        """
SELECT site, date, round((aqi - m) / s, 6) AS z, round(least(aqi, cap), 6) AS capped
FROM air, (SELECT avg(aqi) AS m, stddev_pop(aqi) AS s, avg(aqi) + 2 * stddev_samp(aqi) AS cap FROM air WHERE year(date) < 2000)
"""
    ),
)
def train_stats_apply(spark: SparkSession, folder: str) -> Frame:
    """Statistics of the train rows applied to all rows, without a driver round trip or a join."""
    air = daily.stored(daily.air(spark, folder).select(*KEYS, "aqi"))
    train = air.filter(F.year("date") < TEST_FROM)
    known = constants(
        train,
        {"m": F.avg("aqi"), "s": F.stddev_pop("aqi"), "cap": F.avg("aqi") + 2 * F.stddev_samp("aqi")},
    )
    z = (F.col("aqi") - known["m"]) / known["s"]
    return air.select(*KEYS, r(z, "z"), r(S.winsorize("aqi", known["cap"]), "capped"))


# ---- splits ----------------------------------------------------------------------------------

SPLIT_REL = """rel AS (SELECT site, date, aqi, CASE
    WHEN date >= newest - INTERVAL 1 YEAR THEN 'test'
    WHEN date >= newest - INTERVAL 1 YEAR - INTERVAL 1 YEAR THEN 'val' ELSE 'train' END AS split
  FROM air, (SELECT max(date) AS newest FROM air))"""


def relative(spark: SparkSession, folder: str) -> Frame:
    return P.split_relative(daily.stored(daily.air(spark, folder).select(*KEYS, "aqi")))


@query("split_relative", daily_sql("SELECT * FROM rel", SPLIT_REL))
def split_relative(spark: SparkSession, folder: str) -> Frame:
    return relative(spark, folder)


@query(
    "split_relative_two_way",
    daily_sql(
        "SELECT site, date, CASE WHEN date >= (SELECT max(date) FROM air) - INTERVAL 1 YEAR "
        "THEN 'test' ELSE 'train' END AS split FROM air"
    ),
)
def split_relative_two_way(spark: SparkSession, folder: str) -> Frame:
    return P.split_relative(daily.stored(daily.air(spark, folder).select(*KEYS)), validation=False)


@query(
    "split_by_year",
    daily_sql(
        "SELECT site, date, total, CASE WHEN year(date) >= 2000 THEN 'test' WHEN year(date) = 1999 THEN 'val' "
        "ELSE 'train' END AS split FROM pollen"
    ),
)
def split_by_year(spark: SparkSession, folder: str) -> Frame:
    return P.split_by_year(daily.pollen(spark, folder).select(*KEYS, "total"), TEST_FROM, val_year=VAL_YEAR)


@query(
    "split_by_year_single_test",
    daily_sql(
        "SELECT site, date, CASE WHEN year(date) = 2000 THEN 'test' WHEN year(date) < 2000 THEN 'train' END AS split "
        "FROM pollen"
    ),
)
def split_by_year_single_test(spark: SparkSession, folder: str) -> Frame:
    """Train before a year, test on that year alone; later rows belong to neither."""
    return P.split_by_year(daily.pollen(spark, folder).select(*KEYS), TEST_FROM, test_to=TEST_FROM)


@query(
    "split_fraction",
    daily_sql(
        "SELECT site, date, CASE WHEN row_number() OVER (PARTITION BY site ORDER BY date) <= "
        "count(*) OVER (PARTITION BY site) - ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY site)) "
        "THEN 'train' ELSE 'test' END AS split FROM weather"
    ),
)
def split_fraction(spark: SparkSession, folder: str) -> Frame:
    return P.split_fraction(daily.weather(spark, folder).select(*KEYS), 0.2, ["site"])


@query(
    "split_sizes",
    daily_sql(
        "SELECT split, count(*) AS n_rows, round(100.0 * count(*) / (SELECT count(*) FROM rel), 6) AS pct "
        "FROM rel GROUP BY split",
        SPLIT_REL,
    ),
)
def split_sizes(spark: SparkSession, folder: str) -> Frame:
    return rounded(P.split_sizes(relative(spark, folder)), 6, "pct")


@query(
    "leakage_check",
    daily_sql(
        "SELECT *, train_to < val_from AND val_to < test_from AS ok FROM ("
        "SELECT max(date) FILTER (WHERE split = 'train') AS train_to, min(date) FILTER (WHERE split = 'val') AS val_from, "
        "max(date) FILTER (WHERE split = 'val') AS val_to, min(date) FILTER (WHERE split = 'test') AS test_from FROM rel)",
        SPLIT_REL,
    ),
)
def leakage_check(spark: SparkSession, folder: str) -> Frame:
    return P.leakage_check(relative(spark, folder))


@query("union_splits", daily_sql("SELECT site, date, aqi FROM rel WHERE split IN ('train', 'val')", SPLIT_REL))
def union_splits(spark: SparkSession, folder: str) -> Frame:
    parts = relative(spark, folder)
    return P.union_splits(*[parts.filter(F.col("split") == s).drop("split") for s in ("train", "val")])


# ---- sorts and top-k -------------------------------------------------------------------------


@query("sort_date", daily_sql("SELECT date, site, aqi FROM air ORDER BY date, site"))
def sort_date(spark: SparkSession, folder: str) -> Frame:
    return O.by_date(daily.air(spark, folder).select("date", "site", "aqi"), "date", "site")


@query("sort_abs", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC")
def sort_abs(spark: SparkSession, folder: str) -> Frame:
    return O.by_size(read_table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    "top_k",
    "SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20) "
    "ORDER BY o_totalprice, o_orderkey",
)
def top_k(spark: SparkSession, folder: str) -> Frame:
    return O.top_k(read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


@query("preview", daily_sql("SELECT * FROM air ORDER BY date, site LIMIT 5"))
def preview(spark: SparkSession, folder: str) -> Frame:
    return O.preview(daily.air(spark, folder), ["date", "site"])


# ---- scalar functions ------------------------------------------------------------------------


@query(
    "calendar_parts",
    """
SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
       dayofyear(o_orderdate) AS day_of_year, weekofyear(o_orderdate) AS week_of_year,
       isodow(o_orderdate) - 1 AS weekday, dayname(o_orderdate) AS weekday_name,
       CAST(isodow(o_orderdate) >= 6 AS BIGINT) AS is_weekend FROM orders
""",
)
def calendar_parts(spark: SparkSession, folder: str) -> Frame:
    parts = S.calendar_parts("o_orderdate")
    df = read_table(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])
    return big(df, *[n for n in parts if n != "weekday_name"])


@query(
    "cyclic_encoding",
    """
SELECT o_orderkey,
       round(sin(2 * pi() * month(o_orderdate) / 12), 6) AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) AS month_cos,
       round(sin(2 * pi() * dayofyear(o_orderdate) / 365.25), 6) AS day_sin,
       round(cos(2 * pi() * dayofyear(o_orderdate) / 365.25), 6) AS day_cos,
       round(sin(4 * pi() * dayofyear(o_orderdate) / 365.25), 6) AS day_sin2,
       round(cos(4 * pi() * dayofyear(o_orderdate) / 365.25), 6) AS day_cos2,
       round(sin(2 * pi() * (isodow(o_orderdate) - 1) / 7), 6) AS weekday_sin FROM orders
""",
)
def cyclic_encoding(spark: SparkSession, folder: str) -> Frame:
    parts = S.calendar_parts("o_orderdate")
    month = S.cyclic(parts["month"], 12)
    day, day2 = S.cyclic(parts["day_of_year"], 365.25), S.cyclic(parts["day_of_year"], 365.25, harmonic=2)
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        r(month[0], "month_sin"),
        r(month[1], "month_cos"),
        r(day[0], "day_sin"),
        r(day[1], "day_cos"),
        r(day2[0], "day_sin2"),
        r(day2[1], "day_cos2"),
        r(S.cyclic(parts["weekday"], 7)[0], "weekday_sin"),
    )


@query(
    "season_code",
    "SELECT (month(o_orderdate) % 12 + 3) // 3 AS season, count(*) AS n FROM orders GROUP BY 1",
)
def season_code(spark: SparkSession, folder: str) -> Frame:
    season = S.season_code(F.month("o_orderdate")).cast("bigint").alias("season")
    return read_table(spark, folder, "orders").groupBy(season).agg(F.count(F.lit(1)).alias("n"))


@query(
    "year_normalized",
    "SELECT o_orderkey, year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders) AS years FROM orders",
)
def year_normalized(spark: SparkSession, folder: str) -> Frame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    first = constants(orders, {"first": F.min("year")})["first"]
    return orders.select("o_orderkey", (F.col("year") - first).cast("bigint").alias("years"))


@query(
    "log_roundtrip",
    "SELECT l_returnflag, round(avg(ln(1 + l_quantity)), 6) AS mean_log, "
    "round(avg(exp(ln(1 + l_quantity)) - 1), 6) AS mean_back FROM lineitem GROUP BY 1",
)
def log_roundtrip(spark: SparkSession, folder: str) -> Frame:
    logged = F.log1p("l_quantity")
    return read_table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        r(F.avg(logged), "mean_log"), r(F.avg(F.expm1(logged)), "mean_back")
    )


@query(
    "asinh_roundtrip",
    "SELECT l_returnflag, round(avg(asinh(l_quantity)), 6) AS mean_asinh, "
    "round(avg(sinh(asinh(l_quantity))), 6) AS mean_back FROM lineitem GROUP BY 1",
)
def asinh_roundtrip(spark: SparkSession, folder: str) -> Frame:
    bent = F.asinh("l_quantity")
    return read_table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        r(F.avg(bent), "mean_asinh"), r(F.avg(F.sinh(bent)), "mean_back")
    )


@query(
    "aqi_band",
    daily_sql(
        "SELECT site, date, CASE WHEN aqi <= 50 THEN 0 WHEN aqi <= 100 THEN 1 WHEN aqi <= 150 THEN 2 "
        "WHEN aqi <= 200 THEN 3 ELSE 4 END AS band FROM (SELECT site, date, CASE WHEN dayofyear(date) % 11 <> 0 "
        "THEN aqi END AS aqi FROM air)"
    ),
)
def aqi_band(spark: SparkSession, folder: str) -> Frame:
    """Days without a reading fall into the top band."""
    known = F.when(F.dayofyear("date") % 11 != 0, F.col("aqi"))
    return daily.air(spark, folder).select(*KEYS, S.aqi_band(known).alias("band"))


def _level_sql(kind: str) -> str:
    low, mid, high = S.POLLEN_LEVEL_LIMITS[kind]
    return (
        f"CASE WHEN {kind} < 1 THEN 0 WHEN {kind} <= {low} THEN 1 WHEN {kind} <= {mid} THEN 2 "
        f"WHEN {kind} <= {high} THEN 3 ELSE 4 END AS {kind}_level"
    )


@query("level_bands", daily_sql("SELECT site, date, " + ", ".join(map(_level_sql, S.POLLEN_LEVEL_LIMITS)) + " FROM pollen"))
def level_bands(spark: SparkSession, folder: str) -> Frame:
    levels = [S.pollen_level(kind, kind).alias(f"{kind}_level") for kind in S.POLLEN_LEVEL_LIMITS]
    return daily.pollen(spark, folder).select(*KEYS, *levels)


def bin_sql(x: str, edges: list[int]) -> str:
    cases = " ".join(
        f"WHEN {x} > {lo} AND {x} <= {hi} THEN '({lo}, {hi}]'" for lo, hi in zip(edges, edges[1:])
    )
    return f"CASE {cases} END"


@query(
    "bin_edges",
    f"SELECT l_linestatus, {bin_sql('l_quantity - 1', S.RAIN_EDGES)} AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def bin_edges(spark: SparkSession, folder: str) -> Frame:
    """Right-closed bins; 0 lies outside and gets null."""
    label = S.bin_label(F.col("l_quantity") - 1, S.RAIN_EDGES).alias("bin")
    return read_table(spark, folder, "lineitem").groupBy("l_linestatus", label).agg(F.count(F.lit(1)).alias("n"))


@query(
    "bin_means",
    daily_sql(
        f"""
SELECT bin_from, count(total) AS n, round(avg(total), 6) AS mean_total
FROM (VALUES (0), (1), (5), (10), (20)) e(bin_from) LEFT JOIN
     (SELECT *, CASE WHEN rain > 0 AND rain <= 1 THEN 0 WHEN rain > 1 AND rain <= 5 THEN 1 WHEN rain > 5 AND rain <= 10 THEN 5
              WHEN rain > 10 AND rain <= 20 THEN 10 WHEN rain > 20 AND rain <= 100 THEN 20 END AS bin_from FROM all_three) USING (bin_from)
GROUP BY bin_from
"""
    ),
)
def bin_means(spark: SparkSession, folder: str) -> Frame:
    """Rows and mean target per rain bin; unused bins are kept with no mean."""
    edges = S.RAIN_EDGES
    binned = daily.all_three(spark, folder).select("total", S.bin_index("rain", edges).alias("bin"))
    sums = binned.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.count("total").alias("n"), F.avg("total").alias("mean_total")
    )
    every = spark.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    start = F.get(F.array(*[F.lit(e) for e in edges]), F.col("bin"))
    return every.join(sums, "bin", "left").select(
        start.alias("bin_from"), F.coalesce("n", F.lit(0)).alias("n"), r("mean_total", "mean_total")
    )


@query(
    "jitter",
    daily_sql(
        """
SELECT site, date, round(ln(1 + rain), 6) AS log_rain, round(ln(1 + rain) + 0.01 * u, 6) AS uniform,
  round(ln(1 + rain) + 0.1 * sqrt(-2 * ln((a + 1) / 4503599627370496e0)) * cos(2 * pi() * v), 6) AS normal
FROM (SELECT site, date, rain, a, a / 4503599627370496e0 AS u, ('0x' || substr(h, 14, 13))::BIGINT / 4503599627370496e0 AS v
      FROM (SELECT *, ('0x' || substr(h, 1, 13))::BIGINT AS a FROM (SELECT *, md5(site || ':' || date || ':42') AS h FROM weather)))
"""
    ),
)
def jitter(spark: SparkSession, folder: str) -> Frame:
    """Uniform and normal noise that follows from the row's key and the seed."""
    noisy = noisy_rain(spark, folder)
    return rounded(noisy, 6, "log_rain", "uniform", "normal")


def noisy_rain(spark: SparkSession, folder: str) -> Frame:
    rain = daily.weather(spark, folder).select(*KEYS, F.log1p("rain").alias("log_rain"))
    return rain.select("*", S.jitter("log_rain", KEYS, 42).alias("uniform"), S.jitter_normal("log_rain", KEYS, 42).alias("normal"))


@query("jitter_bounds", daily_sql("SELECT site, date, true AS in_range FROM weather"))
def jitter_bounds(spark: SparkSession, folder: str) -> Frame:
    """Uniform noise stays within its width."""
    noisy = noisy_rain(spark, folder)
    added = F.col("uniform") - F.col("log_rain")
    return noisy.select(*KEYS, ((added >= -1e-12) & (added < 0.01 + 1e-12)).alias("in_range"))


@query(
    "interactions",
    daily_sql("SELECT site, date, round(temp * aqi, 6) AS temp_x_aqi, round(wind * o3, 6) AS wind_x_o3 FROM air_weather"),
)
def interactions(spark: SparkSession, folder: str) -> Frame:
    joined = daily.air_weather(spark, folder)
    pairs = [("temp", "aqi"), ("humidity", "pm25"), ("wind", "o3")]
    return rounded(joined.select(*KEYS, *W.products(pairs, joined.columns)), 6, "temp_x_aqi", "wind_x_o3")


@query(
    "string_clean",
    """
SELECT c_custkey, replace(replace(lower(trim(c_name || ' / ' || c_mktsegment)), ' ', '_'), '/', '_') AS cleaned,
       ends_with(c_mktsegment, 'RY') AS ends_ry, contains(c_mktsegment, 'MACH') AS has_mach FROM customer
""",
)
def string_clean(spark: SparkSession, folder: str) -> Frame:
    joined = F.concat_ws(" / ", "c_name", "c_mktsegment")
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        S.clean_text(joined).alias("cleaned"),
        F.col("c_mktsegment").endswith("RY").alias("ends_ry"),
        F.col("c_mktsegment").contains("MACH").alias("has_mach"),
    )


@query(
    "back_in_time",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS year_before, "
    "CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 DAY AS DATE) AS days_before FROM orders",
)
def back_in_time(spark: SparkSession, folder: str) -> Frame:
    day = F.col("o_orderdate").cast("date")
    return read_table(spark, folder, "orders").select(
        "o_orderkey", S.back_in_time(day, years=1).alias("year_before"), S.back_in_time(day, days=3).alias("days_before")
    )


@query(
    "standardize",
    "SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 6) AS l_quantity, round((l_tax - mt) / st, 6) AS l_tax "
    "FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)",
)
def standardize(spark: SparkSession, folder: str) -> Frame:
    df = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return rounded(G.standardized(df, ["l_quantity", "l_tax"]), 6, "l_quantity", "l_tax")
