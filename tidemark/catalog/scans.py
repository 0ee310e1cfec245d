"""Sources and sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.base import daily_sql, query
from tidemark.operators import windows as W
from tidemark.operators.metrics import regression_metrics
from tidemark.plans.scratch import scratch_root
from tidemark.sources import daily
from tidemark.sources.readers import load_bundle, read_csv, read_csv_after_preamble, read_table
from tidemark.sources.sinks import write_csv, write_metrics

TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders",
    "pages", "part", "region", "supplier",
]


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


@query(
    "scan_tables",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
)
def scan_tables(spark: SparkSession, folder: str) -> DataFrame:
    counts = [
        read_table(spark, folder, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "csv_preamble_scan",
    daily_sql("SELECT site, CASE WHEN day(date) <> 13 THEN date END AS date, temp, rain, wind FROM weather"),
)
def csv_preamble_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the weather table as text files, each behind a metadata line that looks like a row, and read
    them back. The date of each 13th is written unreadable: such rows stay, without a date."""
    path = scratch_path(spark, "weather-text")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    date = F.when(F.day("date") == 13, F.lit("no date")).otherwise(F.col("date").cast("string")).alias("time")
    rows = daily.weather(spark, folder).select(
        F.pmod(F.xxhash64("date", "site"), F.lit(files)).alias("file"),
        F.lit(0).alias("nth"),
        F.to_csv(F.struct(date, "site", "temp", "rain", "wind")).alias("value"),
    )
    lines = ["latitude,longitude,elevation", "2019,-71.1,38.0", "", "time,site,temp,rain,wind"]
    head = [(nth - len(lines), line) for nth, line in enumerate(lines)]
    head = spark.createDataFrame(head, "nth int, value string")
    head = head.select(F.explode(F.expr(f"sequence(0L, {files - 1}L)")).alias("file"), "nth", "value")
    placed = rows.unionByName(head).repartition(files, "file").sortWithinPartitions("file", "nth")
    placed.select("file", "value").write.partitionBy("file").text(path)
    schema = T.StructType.fromDDL("time date, site int, temp double, rain double, wind double")
    read = read_csv_after_preamble(spark, path, schema)
    return read.select("site", F.col("time").alias("date"), "temp", "rain", "wind")


@query("csv_plain_scan", daily_sql("SELECT site, date, aqi, pm25, co FROM air"))
def csv_plain_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "air-csv")
    write_csv(daily.air(spark, folder).select("site", "date", "aqi", "pm25", "co"), path)
    return read_csv(spark, path, "site int, date date, aqi double, pm25 double, co double")


@query("sink_roundtrip", daily_sql("SELECT * FROM all_three"))
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The merged hand-off table, written as CSV and read back under its schema."""
    merged = daily.all_three(spark, folder)
    path = scratch_path(spark, "merged")
    write_csv(merged, path)
    return read_csv(spark, path, merged.schema)


PERSISTENCE_SQL = "naive AS (SELECT *, lag(aqi) OVER (PARTITION BY site ORDER BY date) AS predicted FROM air)"


def persistence_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Tomorrow equals today: the plainest forecast, used to check the metrics."""
    air = daily.air(spark, folder)
    return air.withColumn("predicted", W.lag("aqi", 1, W.series_window(["site"])))


@query(
    "metrics_sink",
    daily_sql(
        "SELECT count(*) AS n, round(avg(abs(aqi - predicted)), 6) AS mae, "
        "round(sqrt(avg((aqi - predicted) ** 2)), 6) AS rmse FROM naive WHERE predicted IS NOT NULL",
        PERSISTENCE_SQL,
    ),
)
def metrics_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    metrics = regression_metrics(persistence_forecast(spark, folder), "aqi", "predicted")
    write_metrics(metrics.select("n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse")), path)
    return spark.read.schema("n bigint, mae double, rmse double").json(path)


@query(
    "load_bundle",
    """
SELECT 'orders' AS table_name, count(*) AS n_rows, min(date_trunc('second', o_orderdate)) AS first_time,
       max(date_trunc('second', o_orderdate)) AS last_time FROM orders
UNION ALL
SELECT 'lineitem', count(*), min(date_trunc('second', l_shipdate)), max(date_trunc('second', l_shipdate)) FROM lineitem
UNION ALL
SELECT 'events', count(*), min(date_trunc('second', ts)), max(date_trunc('second', ts)) FROM events
""",
)
def load_bundle_query(spark: SparkSession, folder: str) -> DataFrame:
    """Three named tables in one call, all time columns cut to the second."""
    times = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "event_time"}
    tables = {name: read_table(spark, folder, name) for name in times}
    tables["events"] = tables["events"].withColumnRenamed("ts", "event_time")
    bundle = load_bundle(tables)
    parts = [
        bundle[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min(column).alias("first_time"),
            F.max(column).alias("last_time"),
        )
        for name, column in times.items()
    ]
    return reduce(DataFrame.unionByName, parts)
