"""Profiles, distributions, correlations and smooth curves over whole tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import big, daily_sql, query, r, rounded
from tidemark.functions.scalars import pollen_level
from tidemark.operators import resample as M
from tidemark.operators import smooth as K
from tidemark.operators import stats as G
from tidemark.operators import windows as W
from tidemark.plans.ranking import join_group_stats, quantiles, quantiles_of_ranked, ranked_counts
from tidemark.sources import daily
from tidemark.sources.daily import sql_gaps, with_gaps
from tidemark.sources.readers import read_table

KEYS = ["site", "date"]
LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAP_COLS = ["aqi", "pm25", "o3", "co", "so2", "temp", "rain", "wind", "total"]
GAPPY = "gappy AS (" + sql_gaps("all_three", "site date " + " ".join(GAP_COLS)) + ")"


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    return with_gaps(daily.all_three(spark, folder).select(*KEYS, *GAP_COLS))


# ---- profiles --------------------------------------------------------------------------------


@query(
    "profile_span",
    daily_sql(
        "SELECT site, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, "
        "CAST(max(date) - min(date) AS BIGINT) AS span_days, round((max(date) - min(date)) / 365.25, 6) AS span_years "
        "FROM air_weather GROUP BY site"
    ),
)
def profile_span(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.profile_span(daily.air_weather(spark, folder), by=["site"]), 6, "span_years")


@query(
    "col_range_stats",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS variable, min({c}) AS min_value, max({c}) AS max_value, round(avg({c}), 4) AS mean_value FROM lineitem"
        for c in LINE_COLS
    ),
)
def col_range_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.column_ranges(read_table(spark, folder, "lineitem"), LINE_COLS), 4, "mean_value")


@query(
    "group_mean",
    "SELECT month(l_shipdate) AS month, round(avg(l_quantity), 6) AS mean_l_quantity, "
    "round(avg(l_discount), 6) AS mean_l_discount FROM lineitem GROUP BY 1",
)
def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    month = F.month("l_shipdate").cast("bigint").alias("month")
    means = G.group_mean(read_table(spark, folder, "lineitem"), [month], ["l_quantity", "l_discount"])
    return rounded(means, 6, "mean_l_quantity", "mean_l_discount")


@query(
    "value_counts",
    "SELECT coalesce(q, v.value) AS l_quantity, count(q) AS n FROM generate_series(0, 60) v(value) "
    "FULL JOIN (SELECT CAST(l_quantity AS BIGINT) AS q FROM lineitem WHERE l_quantity IS NOT NULL) ON q = v.value GROUP BY 1",
)
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per whole quantity; values that never occur are listed with 0."""
    quantity = read_table(spark, folder, "lineitem").select(F.col("l_quantity").cast("bigint"))
    return G.value_counts(quantity, "l_quantity", spark.range(61).withColumnRenamed("id", "l_quantity"))


@query("distinct_years", "SELECT DISTINCT year(o_orderdate) AS year FROM orders")
def distinct_years(spark: SparkSession, folder: str) -> DataFrame:
    return G.distinct_values(read_table(spark, folder, "orders"), F.year("o_orderdate").cast("bigint"), "year")


@query(
    "distinct_counts",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers "
    "FROM lineitem GROUP BY 1",
)
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Keys are made distinct per task before the shuffle, then counted."""
    return read_table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_suppkey").alias("n_suppliers")
    )


@query(
    "describe",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"min({c}) AS min, max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
        f"round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem"
        for c in LINE_COLS
    ),
)
def describe(spark: SparkSession, folder: str) -> DataFrame:
    df = read_table(spark, folder, "lineitem").select(*LINE_COLS)
    return rounded(G.describe(df, LINE_COLS), 4, "mean", "std", "q25", "q50", "q75")


@query(
    "null_info",
    daily_sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS variable, '{t}' AS dtype, count({c}) AS n_present, count(*) - count({c}) AS n_null FROM gappy"
            for c, t in [("site", "int"), ("date", "date"), *[(c, "double") for c in GAP_COLS]]
        ),
        GAPPY,
    ),
)
def null_info(spark: SparkSession, folder: str) -> DataFrame:
    return G.null_info(gappy(spark, folder))


@query(
    "null_mask",
    daily_sql("SELECT site, date, CAST(pm25 IS NULL AS INTEGER) AS pm25, CAST(rain IS NULL AS INTEGER) AS rain FROM gappy", GAPPY),
)
def null_mask(spark: SparkSession, folder: str) -> DataFrame:
    return G.null_mask(gappy(spark, folder), KEYS, ["pm25", "rain"])


@query(
    "null_matrix",
    daily_sql(
        "SELECT last_day(date) AS period, "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in GAP_COLS)
        + " FROM gappy GROUP BY 1",
        GAPPY,
    ),
)
def null_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return G.null_matrix(gappy(spark, folder), GAP_COLS, F.last_day("date"))


# ---- resampling ------------------------------------------------------------------------------


def _monthly_sql(source: str, cols: list[str]) -> str:
    means = ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in cols)
    return f"""
SELECT c.site, c.month_end, {", ".join(f"mean_{c}" for c in cols)}
FROM (SELECT site, last_day(CAST(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS DATE)) AS month_end
      FROM {source} GROUP BY site) c
LEFT JOIN (SELECT site, last_day(date) AS month_end, {means} FROM {source} GROUP BY 1, 2) USING (site, month_end)
"""


@query(
    "resample_month",
    daily_sql(_monthly_sql("season", ["total", "tree"]), "season AS (SELECT * FROM pollen WHERE month(date) BETWEEN 3 AND 10)"),
)
def resample_month(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly means of the season table: the winter months are kept as empty rows."""
    season = daily.pollen(spark, folder).filter(F.month("date").between(3, 10))
    return rounded(M.monthly_mean(season, ["total", "tree"], ["site"]), 6, "mean_total", "mean_tree")


@query(
    "resample_month_recent",
    daily_sql(
        _monthly_sql("recent", ["aqi", "temp", "rain"]),
        "recent AS (SELECT * FROM air_weather WHERE date >= DATE '1999-01-01')",
    ),
)
def resample_month_recent(spark: SparkSession, folder: str) -> DataFrame:
    recent = daily.air_weather(spark, folder).filter(F.col("date") >= F.lit("1999-01-01").cast("date"))
    cols = ["aqi", "temp", "rain"]
    return rounded(M.monthly_mean(recent, cols, ["site"]), 6, *[f"mean_{c}" for c in cols])


# ---- order statistics ------------------------------------------------------------------------

PROBS = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}


@query(
    "quantiles",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS {n}" for n, q in PROBS.items())
    + " FROM lineitem GROUP BY 1",
)
def quantiles_query(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of raw prices per flag; no group passes through one task."""
    df = read_table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return rounded(quantiles(df, "l_extendedprice", PROBS, ["l_returnflag"]), 4, *PROBS)


@query(
    "quantiles_two_scans",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 4) AS {n}" for n, q in PROBS.items())
    + " FROM lineitem GROUP BY 1",
)
def quantiles_two_scans(spark: SparkSession, folder: str) -> DataFrame:
    """The other way round: the whole table is ranked, as it is when a bracket misses its rank."""
    df = read_table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    ranked = ranked_counts(df, "l_extendedprice", ["l_returnflag"])
    return rounded(quantiles_of_ranked(ranked, "l_extendedprice", PROBS, ["l_returnflag"]), 4, *PROBS)


@query(
    "quantiles_approx_error",
    "\nUNION ALL ".join(f"SELECT l_returnflag, '{n}' AS name, true AS within_bound FROM lineitem GROUP BY 1" for n in PROBS),
)
def quantiles_approx_error(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the sketch keeps its promise: the rank of each value lies between (q - e) x rows, rounded
    down, and (q + e) x rows, rounded up, with e = 1 / accuracy."""
    accuracy = 1_000
    df = read_table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    sketch = quantiles(df, "l_extendedprice", PROBS, ["l_returnflag"], accuracy=accuracy)
    x = F.col("l_extendedprice")
    shares = join_group_stats(df, sketch, ["l_returnflag"]).groupBy("l_returnflag").agg(
        F.count(x).alias("rows"),
        *[F.struct(F.count_if(x < F.col(n)).alias("below"), F.count_if(x <= F.col(n)).alias("upto")).alias(n) for n in PROBS],
    )
    slack = 1 / accuracy
    checks = [
        F.struct(
            F.lit(n).alias("name"),
            (
                (F.col(n)["below"] <= F.ceil(F.col("rows") * (q + slack)))
                & (F.col(n)["upto"] >= F.floor(F.col("rows") * (q - slack)))
            ).alias("within_bound"),
        )
        for n, q in PROBS.items()
    ]
    return shares.select("l_returnflag", F.inline(F.array(*checks)))


@query("quantiles_approx")
def quantiles_approx(spark: SparkSession, folder: str) -> DataFrame:
    df = read_table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    return quantiles(df, "l_extendedprice", PROBS, ["l_returnflag"], accuracy=10_000)


@query(
    "median_mean",
    "SELECT round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(avg(o_totalprice), 4) AS mean FROM orders",
)
def median_mean(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_totalprice")
    summary = G.describe(orders, ["o_totalprice"])
    return summary.select(r("q50", "median", 4), r("mean", "mean", 4))


def _box_sql(table: str, value: str, group: str | None) -> str:
    g = f"{group} AS grp, " if group else "1 AS grp, "
    out = "grp, " if group else ""
    return f"""
SELECT {out}count(*) AS n, max(q25) AS q25, max(q50) AS q50, max(q75) AS q75,
       min(v) FILTER (WHERE v BETWEEN lo AND hi) AS whisker_low, max(v) FILTER (WHERE v BETWEEN lo AND hi) AS whisker_high,
       count(*) FILTER (WHERE v NOT BETWEEN lo AND hi) AS n_outliers
FROM (SELECT {g}{value} AS v FROM {table}) JOIN (
  SELECT grp, q25, q50, q75, q25 - 1.5::DOUBLE * (q75 - q25) AS lo, q75 + 1.5::DOUBLE * (q75 - q25) AS hi FROM (
    SELECT grp, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75
    FROM (SELECT {g}{value} AS v FROM {table}) GROUP BY grp)) USING (grp)
GROUP BY grp
"""


BOX = ["q25", "q50", "q75", "whisker_low", "whisker_high"]


def _rounded_box_sql(inner: str, group: bool) -> str:
    kept = ("grp, " if group else "") + "n, n_outliers, "
    return f"SELECT {kept}" + ", ".join(f"round({c}, 4) AS {c}" for c in BOX) + f" FROM ({inner})"


@query("boxplot_stats", _rounded_box_sql(_box_sql("customer", "c_acctbal * c_acctbal / 1000", None), False))
def boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    """One box over the whole table, with outliers."""
    x = read_table(spark, folder, "customer").select((F.col("c_acctbal") * F.col("c_acctbal") / 1000).alias("x"))
    return rounded(G.box_stats(x, "x"), 4, *BOX)


@query(
    "boxplot_by_weekday",
    _rounded_box_sql(_box_sql("orders", "o_totalprice * o_totalprice / 1e9", "dayname(o_orderdate)"), True),
)
def boxplot_by_weekday(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "EEEE").alias("grp"), (F.col("o_totalprice") * F.col("o_totalprice") / 1e9).alias("x")
    )
    return rounded(G.box_stats(orders, "x", ["grp"]), 4, *BOX)


@query(
    "boxplot_by_season",
    _rounded_box_sql(_box_sql("lineitem", "l_extendedprice", "(month(l_shipdate) % 12 + 3) // 3"), True),
)
def boxplot_by_season(spark: SparkSession, folder: str) -> DataFrame:
    season = F.floor((F.month("l_shipdate") % 12 + 3) / 3).alias("grp")
    lines = read_table(spark, folder, "lineitem").select(season, F.col("l_extendedprice").alias("x"))
    return rounded(G.box_stats(lines, "x", ["grp"]), 4, *BOX)


@query(
    "boxplot_outliers",
    daily_sql(
        "SELECT site, date, total FROM pollen, (SELECT quantile_cont(total, 0.25) AS a, quantile_cont(total, 0.75) AS b FROM pollen) "
        "WHERE total < a - 1.5::DOUBLE * (b - a) OR total > b + 1.5::DOUBLE * (b - a)"
    ),
)
def boxplot_outliers(spark: SparkSession, folder: str) -> DataFrame:
    pollen = daily.stored(daily.pollen(spark, folder).select(*KEYS, "total"))
    return G.outlier_rows(pollen, "total", G.box_stats(pollen, "total"))


@query(
    "histogram",
    """
SELECT b.bin, round(lo + b.bin * w, 4) AS bin_from, round(lo + b.bin * w + w, 4) AS bin_to, coalesce(n, 0) AS n
FROM (SELECT unnest(generate_series(0, 29)) AS bin) b,
     (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30e0 AS w FROM orders)
LEFT JOIN (SELECT least(CAST(floor((o_totalprice - lo) / w) AS BIGINT), 29) AS bin, count(*) AS n
           FROM orders, (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30e0 AS w FROM orders)
           GROUP BY 1) c ON b.bin = c.bin
""",
)
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    bars = G.histogram(read_table(spark, folder, "orders").select("o_totalprice"), "o_totalprice", 30)
    return rounded(bars, 4, "bin_from", "bin_to")


@query(
    "kde",
    """
SELECT CAST(p AS INTEGER) AS point, round(lo + p * ((hi - lo) / 49e0), 4) AS x,
       round(1e6 * sum(exp(-0.5 * pow((lo + p * ((hi - lo) / 49e0) - v) / h, 2))) * 0.3989422804014327 / (max(n) * max(h)), 6) AS density_e6
FROM (SELECT o_totalprice AS v FROM orders),
     (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, CAST(count(*) AS DOUBLE) AS n,
             stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h FROM orders),
     (SELECT unnest(generate_series(0, 49)) AS p)
GROUP BY p, lo, hi
""",
)
def kde(spark: SparkSession, folder: str) -> DataFrame:
    curve = K.kernel_density(read_table(spark, folder, "orders").select("o_totalprice"), "o_totalprice", 50)
    return curve.select("point", r("x", "x", 4), r(F.col("density") * 1e6, "density_e6"))


@query(
    "lowess_grid",
    daily_sql(
        """
SELECT CAST(p AS INTEGER) AS point, round(max(gx), 6) AS x,
  round(CASE WHEN sum(w) * sum(w*d*d) - sum(w*d) * sum(w*d) > 1e-9 * sum(w) * sum(w)
       THEN (sum(w*d*d) * sum(w*y) - sum(w*d) * sum(w*d*y)) / (sum(w) * sum(w*d*d) - sum(w*d) * sum(w*d))
       ELSE sum(w*y) / sum(w) END, 4) AS fitted
FROM (SELECT p, gx, y, x - gx AS d, CASE WHEN abs(x - gx) < h THEN pow(1 - pow(abs(x - gx) / h, 3), 3) ELSE 0 END AS w
      FROM (SELECT *, max(CASE WHEN rk = k THEN abs(x - gx) END) OVER (PARTITION BY p) AS h
            FROM (SELECT p, x, y, lo + p * ((hi - lo) / 14e0) AS gx, k,
                         row_number() OVER (PARTITION BY p ORDER BY abs(x - (lo + p * ((hi - lo) / 14e0)))) AS rk
                  FROM pts, (SELECT min(x) AS lo, max(x) AS hi, CAST(ceil(0.3::DOUBLE * count(*)) AS BIGINT) AS k FROM pts),
                       (SELECT unnest(generate_series(0, 14)) AS p))))
GROUP BY p
""",
        "pts AS (SELECT ln(1 + rain) AS x, total AS y FROM all_three WHERE month(date) BETWEEN 3 AND 9)",
    ),
)
def lowess_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Pollen against log rain in season, 15 grid points, nearest 30 percent of rows."""
    season = daily.all_three(spark, folder).filter(F.month("date").between(3, 9))
    curve = K.lowess(season.select(F.log1p("rain").alias("x"), F.col("total").alias("y")), "x", "y", 0.3, 15, robust=0)
    return curve.select("point", r("x", "x"), r("fitted", "fitted", 4))


def robust_sql(points: int = 15, rounds: int = 3) -> str:
    """Share 2/3 and three rounds of bisquare weights, residuals from the line between grid points."""
    last = points - 1
    fit = (
        "SELECT p, any_value(gx) AS gx, CASE WHEN sum(w) * sum(w*d*d) - sum(w*d) * sum(w*d) > 1e-9 * sum(w) * sum(w) "
        "THEN (sum(w*d*d) * sum(w*y) - sum(w*d) * sum(w*d*y)) / (sum(w) * sum(w*d*d) - sum(w*d) * sum(w*d)) ELSE sum(w*y) / sum(w) END AS f"
    )
    steps = [
        "pts AS MATERIALIZED (SELECT row_number() OVER () AS i, ln(1 + rain) AS x, total::DOUBLE AS y FROM all_three WHERE month(date) BETWEEN 3 AND 9)",
        f"g AS MATERIALIZED (SELECT p, lo + p * ((hi - lo) / {last}e0) AS gx, lo, (hi - lo) / {last}e0 AS step, k FROM "
        f"(SELECT min(x) AS lo, max(x) AS hi, CAST(ceil(count(*) * 2 / 3e0) AS BIGINT) AS k FROM pts), (SELECT unnest(generate_series(0, {last})) AS p))",
        "near AS (SELECT p, gx, k, i, x, y, x - gx AS d, row_number() OVER (PARTITION BY p ORDER BY abs(x - gx)) AS rk FROM pts CROSS JOIN g)",
        "wide AS (SELECT *, max(CASE WHEN rk = k THEN abs(d) END) OVER (PARTITION BY p) AS h FROM near)",
        "cells AS MATERIALIZED (SELECT p, gx, i, y, d, CASE WHEN abs(d) < h THEN pow(1 - pow(abs(d) / h, 3), 3) ELSE 0 END AS w FROM wide)",
        f"f0 AS MATERIALIZED ({fit} FROM cells GROUP BY p)",
    ]
    for n in range(rounds):
        steps += [
            f"r{n} AS MATERIALIZED (SELECT i, abs(y - a.f - (b.f - a.f) * (x - a.gx) / step) AS gap FROM (SELECT pts.*, step, "
            f"least(greatest(floor((x - lo) / step), 0), {last - 1}) AS p FROM pts, (SELECT lo, step FROM g WHERE p = 0)) t "
            f"JOIN f{n} a ON a.p = t.p JOIN f{n} b ON b.p = t.p + 1)",
            f"t{n} AS (SELECT i, CASE WHEN gap < 6 * m THEN pow(1 - pow(gap / (6 * m), 2), 2) ELSE 0 END AS trust FROM r{n}, (SELECT median(gap) AS m FROM r{n}))",
            f"f{n + 1} AS MATERIALIZED ({fit} FROM (SELECT p, gx, y, d, w * trust AS w FROM cells JOIN t{n} USING (i)) GROUP BY p)",
        ]
    return daily_sql(f"SELECT p::INT AS point, round(gx, 6) AS x, round(f, 4) AS fitted FROM f{rounds}", *steps)


@query("lowess_robust", robust_sql())
def lowess_robust(spark: SparkSession, folder: str) -> DataFrame:
    """Pollen against log rain in season: nearest two thirds of the rows, three robust rounds."""
    season = daily.all_three(spark, folder).filter(F.month("date").between(3, 9))
    curve = K.lowess(season.select(F.log1p("rain").alias("x"), F.col("total").alias("y")), "x", "y", points=15)
    return curve.select("point", r("x", "x"), r("fitted", "fitted", 4))


# ---- correlations ----------------------------------------------------------------------------


def corr_sql(table: str, cols: list[str]) -> str:
    cells = [f"SELECT '{c}' AS var_a, '{c}' AS var_b, 1::DOUBLE AS r, count({c}) AS n FROM {table}" for c in cols]
    for a, b in combinations(cols, 2):
        for x, y in ((a, b), (b, a)):
            cells.append(
                f"SELECT '{x}' AS var_a, '{y}' AS var_b, round(corr({x}, {y}), 6) AS r, "
                f"count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n FROM {table}"
            )
    return "\nUNION ALL ".join(cells)


@query("corr_pearson", daily_sql(corr_sql("gappy", GAP_COLS), GAPPY))
def corr_pearson(spark: SparkSession, folder: str) -> DataFrame:
    """Daily table with missing values: each pair over the rows where both are known."""
    return rounded(G.pearson(gappy(spark, folder), GAP_COLS), 6, "r")


@query("corr_pearson_raw", corr_sql("lineitem", LINE_COLS))
def corr_pearson_raw(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.pearson(read_table(spark, folder, "lineitem"), LINE_COLS), 6, "r")


@query(
    "corr_strong",
    daily_sql(f"SELECT * FROM ({corr_sql('gappy', GAP_COLS)}) WHERE abs(r) > 0.4 AND var_a <> var_b", GAPPY),
)
def corr_strong(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.strong_pairs(G.pearson(gappy(spark, folder), GAP_COLS)), 6, "r")


@query(
    "corr_target_rank",
    daily_sql(
        "\nUNION ALL ".join(f"SELECT '{c}' AS variable, round(corr({c}, aqi), 6) AS r FROM gappy" for c in GAP_COLS if c != "aqi"),
        GAPPY,
    ),
)
def corr_target_rank(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.target_ranking(gappy(spark, folder), "aqi", GAP_COLS), 6, "r")


def ranks_sql(source: str, cols: list[str]) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS {c}" for c in cols
    )
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"ranked AS (SELECT {ranks} FROM {source} WHERE {known})"


SPEAR_COLS = ["aqi", "pm25", "rain", "temp", "total"]


@query("corr_spearman", daily_sql(corr_sql("ranked", SPEAR_COLS), GAPPY, ranks_sql("gappy", SPEAR_COLS)))
def corr_spearman(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.spearman(gappy(spark, folder), SPEAR_COLS, KEYS), 6, "r")


LAG_VARS = ["temp", "rain", "wind"]
LAG_COLS = ["total", "aqi", *LAG_VARS, *[f"{v}_lag{k}" for v in LAG_VARS for k in (1, 2, 3)]]


@query(
    "corr_lagged",
    daily_sql(
        f"SELECT * FROM ({corr_sql('ranked', LAG_COLS)}) WHERE var_a IN ('total', 'aqi') AND abs(r) >= 0.02",
        "lagged AS (SELECT total, aqi, temp, rain, wind, "
        + ", ".join(f"lag({v}, {k}) OVER (PARTITION BY site ORDER BY date) AS {v}_lag{k}" for v in LAG_VARS for k in (1, 2, 3))
        + " FROM all_three)",
        ranks_sql("lagged", LAG_COLS),
    ),
)
def corr_lagged(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation of two targets with weather up to three rows back, weak ones hidden."""
    site = W.series_window(["site"])
    lagged = daily.all_three(spark, folder).select(
        *KEYS, "total", "aqi", *LAG_VARS, *[c for v in LAG_VARS for c in W.lags(v, [1, 2, 3], site)]
    )
    table = rounded(G.spearman(lagged, LAG_COLS, KEYS), 6, "r")
    return table.filter(F.col("var_a").isin("total", "aqi") & (F.abs("r") >= 0.02))


NULL_COLS = ["pm25", "o3", "temp", "rain", "total"]


@query(
    "null_corr",
    daily_sql(
        corr_sql("flags", NULL_COLS),
        GAPPY,
        "flags AS (SELECT " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in NULL_COLS) + " FROM gappy)",
    ),
)
def null_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(G.null_correlation(gappy(spark, folder), NULL_COLS), 6, "r")


@query(
    "ols_simple",
    daily_sql(
        "SELECT site, round(regr_slope(total, temp), 6) AS slope, round(regr_intercept(total, temp), 6) AS intercept, "
        "round(regr_r2(total, temp), 6) AS r2, CAST(regr_count(total, temp) AS BIGINT) AS n FROM all_three GROUP BY site"
    ),
)
def ols_simple(spark: SparkSession, folder: str) -> DataFrame:
    fits = G.simple_ols(daily.all_three(spark, folder), "temp", "total", ["site"])
    return big(rounded(fits, 6, "slope", "intercept", "r2"), "n")


@query(
    "class_weights",
    daily_sql(
        """
SELECT CAST(l.k AS INTEGER) AS label, count(c) AS n,
       round((SELECT count(*) FROM lv) / ((SELECT count(DISTINCT c) FROM lv) * CASE WHEN count(c) = 0 THEN 1e-6 ELSE count(c) END), 4) AS weight
FROM (SELECT unnest(generate_series(0, 5)) AS k) l LEFT JOIN lv ON lv.c = l.k GROUP BY l.k
""",
        "lv AS (SELECT CASE WHEN tree < 1 THEN 0 WHEN tree <= 14 THEN 1 WHEN tree <= 89 THEN 2 WHEN tree <= 1499 THEN 3 ELSE 4 END AS c FROM pollen)",
    ),
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced weights of tree levels; label 5 never occurs."""
    levels = daily.pollen(spark, folder).select(pollen_level("tree", "tree").alias("level"))
    return rounded(G.class_weights(levels, "level", list(range(6))), 4, "weight")
