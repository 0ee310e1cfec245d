"""Daily tables derived from order and shipment records.

Each has one row per (site, date); a site is a region. Values come from integer sums, so they do not
depend on the order in which rows arrive. The fact tables are joined to their dimensions after column
pruning and summed per (site, date) with partial sums before the shuffle, so everything after this
step is bounded by sites x calendar days however many records there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.scratch import written
from tidemark.sources.readers import read_table

KEYS = ("site", "date")
AIR_COLS = ("aqi", "pm25", "o3", "co", "no2", "so2")
WEATHER_COLS = ("temp", "rain", "wind", "gust", "apparent", "wind_dir")
POLLEN_COLS = ("tree", "grass", "weed", "total")


def _cents(x: str) -> Column:
    return F.round(F.col(x) * 100).cast("bigint")


def _sites(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").alias("site"))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return (
        read_table(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_sites(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("site", F.col("o_orderdate").cast("date").alias("date"), "o_orderstatus", _cents("o_totalprice").alias("cents"))
    )


def _hundredths(total: str, per: str) -> Column:
    """Whole-number division, then two decimals: the same double in every engine."""
    return F.expr(f"({total}) div ({per})") / F.lit(100.0)


def air(spark: SparkSession, folder: str) -> DataFrame:
    """Air quality: index, five pollutants and the number of readings per site and day."""
    return _orders(spark, folder).groupBy(*KEYS).agg(*_air_columns())


def _air_columns() -> list[Column]:
    return [
        _hundredths("sum(cents)", "count(*) * 1000").alias("aqi"),
        _hundredths("max(cents)", "1000").alias("pm25"),
        _hundredths("min(cents)", "1000").alias("o3"),
        F.count(F.lit(1)).cast("double").alias("co"),
        _hundredths("max(cents) - min(cents)", "2000").alias("no2"),
        _hundredths("sum(cents)", "10000").alias("so2"),
    ]


def pollen(spark: SparkSession, folder: str) -> DataFrame:
    """Pollen counts by type and in total, per site and day."""
    by_type = _orders(spark, folder).groupBy(*KEYS).agg(*_pollen_columns())
    return by_type.withColumn("total", F.col("tree") + F.col("grass") + F.col("weed"))


def _pollen_columns() -> list[Column]:
    def counted(status: str, per: int) -> Column:
        return F.expr(f"coalesce(sum(cents) FILTER (WHERE o_orderstatus = '{status}'), 0) div {per}").cast("double")

    return [
        counted("P", 25_000).alias("tree"),
        counted("F", 200_000).alias("grass"),
        counted("O", 80_000).alias("weed"),
    ]


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Weather: temperature, rain, wind, gusts, apparent temperature and direction per site and day."""
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return (
        read_table(spark, folder, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_sites(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "site",
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            _cents("l_tax").alias("tax"),
            _cents("l_discount").alias("discount"),
            F.col("l_linenumber").cast("bigint").alias("line"),
        )
        .groupBy("site", "date")
        .agg(
            _hundredths("sum(quantity) * 100", "count(*)").alias("temp"),
            _hundredths("sum(discount) * 100", "count(*)").alias("rain"),
            _hundredths("sum(tax) * 100", "count(*)").alias("wind"),
            F.max("quantity").cast("double").alias("gust"),
            F.min("quantity").cast("double").alias("apparent"),
            _hundredths("sum(line) * 5000", "count(*)").alias("wind_dir"),
        )
    )


def air_weather(spark: SparkSession, folder: str) -> DataFrame:
    return air(spark, folder).join(weather(spark, folder), list(KEYS))


def air_pollen(spark: SparkSession, folder: str) -> DataFrame:
    """Air and pollen side by side. Both come from the same records, so one scan of them serves both, in
    place of a join of two aggregates."""
    records = _orders(spark, folder).groupBy(*KEYS).agg(*_air_columns(), *_pollen_columns())
    return records.withColumn("total", F.col("tree") + F.col("grass") + F.col("weed"))


def all_three(spark: SparkSession, folder: str) -> DataFrame:
    """The three tables joined, the orders scanned once."""
    joined = air_pollen(spark, folder).join(weather(spark, folder), list(KEYS))
    return joined.select(*KEYS, *AIR_COLS, *WEATHER_COLS, *POLLEN_COLS)


def stored(df: DataFrame) -> DataFrame:
    """Write a daily table once for jobs that read it several times (statistics, then their use).
    The records are then scanned once; the daily table itself is small."""
    return written(df)


# Missing values follow a fixed calendar rule, because the records themselves have none.
GAP_RULES = {"pm25": 11, "o3": 7, "temp": 13, "rain": 5, "total": 9}


def with_gaps(df: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Null out measured columns on days whose day of year is a multiple of the column's number."""
    chosen = [c for c in GAP_RULES if c in df.columns and (only is None or c in only)]
    gaps = {c: F.when(F.dayofyear("date") % GAP_RULES[c] != 0, F.col(c)) for c in chosen}
    return df.withColumns(gaps) if gaps else df


# The same tables as DuckDB common table expressions, for the result checks.
SQL_TABLES = """
site_orders AS (
  SELECT n_regionkey AS site, CAST(o_orderdate AS DATE) AS date, o_orderstatus,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
air AS (
  SELECT site, date,
         CAST(sum(cents) // (count(*) * 1000) AS DOUBLE) / 1e2 AS aqi,
         CAST(max(cents) // 1000 AS DOUBLE) / 1e2 AS pm25,
         CAST(min(cents) // 1000 AS DOUBLE) / 1e2 AS o3,
         CAST(count(*) AS DOUBLE) AS co,
         CAST((max(cents) - min(cents)) // 2000 AS DOUBLE) / 1e2 AS no2,
         CAST(sum(cents) // 10000 AS DOUBLE) / 1e2 AS so2
  FROM site_orders GROUP BY site, date),
pollen AS (
  SELECT *, tree + grass + weed AS total FROM (
    SELECT site, date,
           CAST(coalesce(sum(cents) FILTER (WHERE o_orderstatus = 'P'), 0) // 25000 AS DOUBLE) AS tree,
           CAST(coalesce(sum(cents) FILTER (WHERE o_orderstatus = 'F'), 0) // 200000 AS DOUBLE) AS grass,
           CAST(coalesce(sum(cents) FILTER (WHERE o_orderstatus = 'O'), 0) // 80000 AS DOUBLE) AS weed
    FROM site_orders GROUP BY site, date)),
weather AS (
  SELECT n_regionkey AS site, CAST(l_shipdate AS DATE) AS date,
         CAST(sum(CAST(l_quantity AS BIGINT)) * 100 // count(*) AS DOUBLE) / 1e2 AS temp,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) * 100 // count(*) AS DOUBLE) / 1e2 AS rain,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) * 100 // count(*) AS DOUBLE) / 1e2 AS wind,
         CAST(max(l_quantity) AS DOUBLE) AS gust,
         CAST(min(l_quantity) AS DOUBLE) AS apparent,
         CAST(sum(CAST(l_linenumber AS BIGINT)) * 5000 // count(*) AS DOUBLE) / 1e2 AS wind_dir
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2),
air_weather AS (SELECT * FROM air JOIN weather USING (site, date)),
all_three AS (SELECT * FROM air_weather JOIN pollen USING (site, date))
"""


def sql_gaps(table: str, columns: str) -> str:
    """SELECT list of ``table`` with the calendar rule of :func:`with_gaps`."""
    picked = []
    for c in columns.split():
        rule = GAP_RULES.get(c)
        picked.append(f"CASE WHEN dayofyear(date) % {rule} <> 0 THEN {c} END AS {c}" if rule else c)
    return f"SELECT {', '.join(picked)} FROM {table}"


