"""Metric jobs over plain forecasts: the last known value, and bands derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import daily_sql, query, r, rounded
from tidemark.catalog.scans import PERSISTENCE_SQL, persistence_forecast
from tidemark.functions.scalars import aqi_band, pollen_level
from tidemark.operators import metrics as E
from tidemark.operators import smooth as K
from tidemark.operators import splits as P
from tidemark.operators import stats as G
from tidemark.operators import windows as W
from tidemark.sources import daily
from tidemark.sources.readers import read_table

KEYS = ["site", "date"]
LABELS = [0, 1, 2, 3, 4]
SCORES = ["mae", "mse", "rmse", "r2"]

METRICS_SQL = (
    "count(*) AS n, round(avg(abs(aqi - predicted)), 4) AS mae, round(avg((aqi - predicted) ** 2), 4) AS mse, "
    "round(sqrt(avg((aqi - predicted) ** 2)), 4) AS rmse, "
    "round(1 - avg((aqi - predicted) ** 2) / var_pop(aqi), 4) AS r2 FROM naive WHERE predicted IS NOT NULL"
)


@query("regression_metrics", daily_sql(f"SELECT {METRICS_SQL}", PERSISTENCE_SQL))
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.regression_metrics(persistence_forecast(spark, folder), "aqi", "predicted"), 4, *SCORES)


@query(
    "metrics_by_split",
    daily_sql(
        "SELECT CASE WHEN year(date) >= 2000 THEN 'test' WHEN year(date) = 1999 THEN 'val' ELSE 'train' END AS split, "
        f"{METRICS_SQL} GROUP BY 1",
        PERSISTENCE_SQL,
    ),
)
def metrics_by_split(spark: SparkSession, folder: str) -> DataFrame:
    """Train metrics next to test metrics."""
    parts = P.split_by_year(persistence_forecast(spark, folder), 2000, val_year=1999)
    return rounded(E.regression_metrics(parts, "aqi", "predicted", ["split"]), 4, *SCORES)


@query(
    "residuals",
    daily_sql("SELECT site, date, round(aqi - predicted, 6) AS residual FROM naive", PERSISTENCE_SQL),
)
def residuals(spark: SparkSession, folder: str) -> DataFrame:
    table = E.residuals(persistence_forecast(spark, folder), "aqi", "predicted")
    return rounded(table.select(*KEYS, "residual"), 6, "residual")


@query(
    "residual_histogram",
    daily_sql(
        """
SELECT b.bin, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(0, 19)) AS bin) b LEFT JOIN
 (SELECT least(CAST(floor((e - lo) / ((hi - lo) / 20e0)) AS BIGINT), 19) AS bin, count(*) AS n
  FROM (SELECT round(aqi - predicted, 2) AS e FROM naive), (SELECT min(round(aqi - predicted, 2)) AS lo, max(round(aqi - predicted, 2)) AS hi FROM naive)
  WHERE e IS NOT NULL GROUP BY 1) c ON b.bin = c.bin
""",
        PERSISTENCE_SQL,
    ),
)
def residual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    errors = E.residuals(persistence_forecast(spark, folder), "aqi", "predicted")
    rounded_errors = daily.stored(errors.select(F.round("residual", 2).alias("e")))
    return G.histogram(rounded_errors, "e", 20).select("bin", "n")


# ---- class metrics ---------------------------------------------------------------------------


def _level(kind: str) -> str:
    low, mid, high = {"tree": (14, 89, 1499), "grass": (4, 19, 199), "weed": (9, 49, 499)}[kind]
    return f"CASE WHEN {kind} < 1 THEN 0 WHEN {kind} <= {low} THEN 1 WHEN {kind} <= {mid} THEN 2 WHEN {kind} <= {high} THEN 3 ELSE 4 END"


LEVELS_SQL = (
    "lv AS (SELECT site, date, "
    + ", ".join(f"{_level(k)} AS {k}_level" for k in ("tree", "grass", "weed"))
    + " FROM pollen), pairs AS (SELECT * FROM (SELECT *, "
    + ", ".join(f"lag({k}_level) OVER (PARTITION BY site ORDER BY date) AS {k}_said" for k in ("tree", "grass", "weed"))
    + " FROM lv) WHERE tree_said IS NOT NULL)"
)


def level_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Today's pollen levels, and yesterday's as the forecast."""
    kinds = ["tree", "grass", "weed"]
    levels = daily.pollen(spark, folder).select(*KEYS, *[pollen_level(k, k).alias(f"{k}_level") for k in kinds])
    site = W.series_window(["site"])
    said = [W.lag(f"{k}_level", 1, site).alias(f"{k}_said") for k in kinds]
    return levels.select("*", *said).filter(F.col("tree_said").isNotNull())


@query(
    "accuracy",
    daily_sql(
        "SELECT *, round((tree + grass + weed) / 3, 6) AS average FROM (SELECT "
        + ", ".join(f"round(avg(CAST({k}_level = {k}_said AS DOUBLE)), 6) AS {k}" for k in ("tree", "grass", "weed"))
        + " FROM pairs)",
        LEVELS_SQL,
    ),
)
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy per target and their plain average, in one pass."""
    kinds = ["tree", "grass", "weed"]
    hits = [r(F.avg((F.col(f"{k}_level") == F.col(f"{k}_said")).cast("double")), k) for k in kinds]
    scores = level_forecast(spark, folder).agg(*hits)
    return scores.withColumn("average", F.round((F.col("tree") + F.col("grass") + F.col("weed")) / 3, 6))


@query(
    "accuracy_by_site",
    daily_sql(
        "SELECT site, round(avg(CAST(tree_level = tree_said AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM pairs GROUP BY site",
        LEVELS_SQL,
    ),
)
def accuracy_by_site(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(E.accuracy(level_forecast(spark, folder), "tree_level", "tree_said", ["site"]), 6, "accuracy")


def _report(actual: str, predicted: str, table: str, labels: list[int]) -> str:
    values = ", ".join(f"({k})" for k in labels)
    return f"""
SELECT CAST(k AS INTEGER) AS label, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
       coalesce(2 * tp / nullif(said + support, 0), 0) AS f1, support
FROM (SELECT k, CAST(count(*) FILTER (WHERE {actual} = k AND {predicted} = k) AS DOUBLE) AS tp, count(*) FILTER (WHERE {actual} = k) AS support,
             count(*) FILTER (WHERE {predicted} = k) AS said FROM (VALUES {values}) l(k), {table} GROUP BY k)
"""


def _rounded_report(report: str) -> str:
    scores = ", ".join(f"round({c}, 6) AS {c}" for c in ("precision", "recall", "f1"))
    return f"SELECT label, {scores}, support FROM ({report})"


@query(
    "classification_report",
    daily_sql(_rounded_report(_report("tree_level", "tree_said", "pairs", [*LABELS, 5])), LEVELS_SQL),
)
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    """With a label 5 that never occurs: its scores are 0."""
    report = E.classification_report(level_forecast(spark, folder), "tree_level", "tree_said", [*LABELS, 5])
    return rounded(report, 6, "precision", "recall", "f1")


def _averages(report: str) -> str:
    macro = ", ".join(f"round(avg({c}), 6) AS {c}" for c in ("precision", "recall", "f1"))
    weighted = ", ".join(f"round(sum({c} * support) / sum(support), 6) AS {c}" for c in ("precision", "recall", "f1"))
    return f"SELECT 'macro' AS average, {macro} FROM ({report}) UNION ALL SELECT 'weighted', {weighted} FROM ({report})"


@query("f1_macro_weighted", daily_sql(_averages(_report("tree_level", "tree_said", "pairs", LABELS)), LEVELS_SQL))
def f1_macro_weighted(spark: SparkSession, folder: str) -> DataFrame:
    report = E.classification_report(level_forecast(spark, folder), "tree_level", "tree_said", LABELS)
    return rounded(E.report_averages(report), 6, "precision", "recall", "f1")


@query(
    "confusion_matrix",
    daily_sql(
        "SELECT CAST(k AS INTEGER) AS actual, "
        + ", ".join(f"count(*) FILTER (WHERE tree_level = k AND tree_said = {j}) AS pred_{j}" for j in LABELS)
        + " FROM (VALUES (0), (1), (2), (3), (4)) l(k), pairs GROUP BY k",
        LEVELS_SQL,
    ),
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return E.confusion_matrix(level_forecast(spark, folder), "tree_level", "tree_said", LABELS)


BANDS_SQL = (
    "bands AS (SELECT CASE WHEN aqi <= 50 THEN 0 WHEN aqi <= 100 THEN 1 WHEN aqi <= 150 THEN 2 WHEN aqi <= 200 THEN 3 ELSE 4 END AS band, "
    "CASE WHEN predicted <= 50 THEN 0 WHEN predicted <= 100 THEN 1 WHEN predicted <= 150 THEN 2 WHEN predicted <= 200 THEN 3 ELSE 4 END AS said "
    "FROM naive WHERE predicted IS NOT NULL)"
)


@query("band_metrics", daily_sql(_rounded_report(_report("band", "said", "bands", LABELS)), PERSISTENCE_SQL, BANDS_SQL))
def band_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """A numeric forecast scored as bands."""
    forecast = persistence_forecast(spark, folder).filter(F.col("predicted").isNotNull())
    bands = forecast.select(aqi_band("aqi").alias("band"), aqi_band("predicted").alias("said"))
    return rounded(E.classification_report(bands, "band", "said", LABELS), 6, "precision", "recall", "f1")


@query(
    "roc_auc",
    """
SELECT round((sum(rk) FILTER (WHERE quality = 1) - p * (p + 1) / 2) / (p * (n - p)), 6) AS auc, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n
FROM (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2e0 AS rk
      FROM labels JOIN documents USING (doc_id)),
     (SELECT CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n FROM labels JOIN documents USING (doc_id))
GROUP BY p, n
""",
)
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    """How well the text length separates the quality label."""
    scored = read_table(spark, folder, "labels").select("doc_id", "quality").join(
        read_table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return rounded(E.roc_auc(scored, "quality", "n_chars"), 6, "auc")


@query(
    "roc_auc_by_flag",
    """
SELECT l_returnflag, round((sum(rk) FILTER (WHERE y = 1) - p * (p + 1) / 2) / (p * (n - p)), 6) AS auc, CAST(p AS BIGINT) AS n_pos, n
FROM (SELECT *, CAST(count(*) FILTER (WHERE y = 1) OVER (PARTITION BY l_returnflag) AS DOUBLE) AS p,
             count(*) OVER (PARTITION BY l_returnflag) AS n FROM (
  SELECT l_returnflag, CAST(l_quantity > 25 AS INTEGER) AS y,
         rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2e0 AS rk
  FROM lineitem))
GROUP BY l_returnflag, p, n
""",
)
def roc_auc_by_flag(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_returnflag", (F.col("l_quantity") > 25).cast("int").alias("y"), "l_extendedprice"
    )
    return rounded(E.roc_auc(lines, "y", "l_extendedprice", ["l_returnflag"]), 6, "auc")


COSTS_SQL = (
    "WITH costs AS (SELECT k, CAST(sum(n * greatest(q - k, 0) * greatest(q - k, 0)) AS DOUBLE) AS cost FROM "
    "(SELECT CAST(l_quantity AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY 1), "
    "(SELECT unnest(generate_series(1, 50)) AS k) GROUP BY k)"
)


@query(
    "knee_point",
    COSTS_SQL
    + """
SELECT k, cost, round(gap, 6) AS gap FROM (
  SELECT k, cost, 1 - (k - k0) / (k1 - k0) - (cost - c0) / (c1 - c0) AS gap
  FROM costs, (SELECT CAST(min(k) AS DOUBLE) AS k0, max(k) AS k1, min(cost) AS c0, max(cost) AS c1 FROM costs))
ORDER BY gap DESC, k LIMIT 1
""",
)
def knee_point(spark: SparkSession, folder: str) -> DataFrame:
    """Knee of a falling convex cost curve: squared excess of quantities over k."""
    per_quantity = (
        read_table(spark, folder, "lineitem")
        .groupBy(F.col("l_quantity").cast("bigint").alias("q"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    excess = F.greatest(F.col("q") - F.col("k"), F.lit(0))
    costs = (
        per_quantity.withColumn("k", F.explode(F.expr("sequence(1L, 50L)")))
        .groupBy("k")
        .agg(F.sum(F.col("n") * excess * excess).cast("double").alias("cost"))
    )
    return rounded(K.knee_point(costs), 6, "gap")


@query(
    "forecast_table_top",
    daily_sql(
        "SELECT site, date, aqi AS observed, predicted FROM naive WHERE predicted IS NOT NULL "
        "ORDER BY abs(aqi - predicted) DESC, site, date LIMIT 10",
        PERSISTENCE_SQL,
    ),
)
def forecast_table_top(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction table (date, observed, predicted): the ten largest misses."""
    table = persistence_forecast(spark, folder).filter(F.col("predicted").isNotNull())
    named = table.select(*KEYS, F.col("aqi").alias("observed"), "predicted")
    return named.orderBy(F.abs(F.col("observed") - F.col("predicted")).desc(), *KEYS).limit(10)
