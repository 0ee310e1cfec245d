"""Table readers: parquet, plain CSV, CSV behind a metadata preamble, and the three-table bundle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import nan_to_null

# Columns of the daily source tables.
POLLUTANT_SCHEMA = (
    "date string, date_local string, `PM2.5` double, O3 double, CO double, NO2 double, SO2 double, "
    "`AQI_PM2.5` double, AQI_O3 double, AQI_CO double, AQI_NO2 double, AQI_SO2 double, AQI double, "
    "AQI_Category string, num_pollutants_available int"
)
WEATHER_SCHEMA = (
    "time string, `temperature_2m_mean (°C)` double, `apparent_temperature_mean (°C)` double, "
    "`precipitation_sum (mm)` double, `wind_gusts_10m_max (km/h)` double, "
    "`wind_speed_10m_max (km/h)` double, `wind_direction_10m_dominant (°)` double"
)
POLLEN_SCHEMA = "Date string, Tree double, Grass double, Weed double, Ragweed double, Total_Pollen double, Year int"

# Columns of the record tables. A known schema spares a job that reads file footers.
TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def read_table(spark: SparkSession, folder: str, name: str, within: Mapping[str, tuple] | None = None) -> DataFrame:
    """A record table. NaN becomes null.

    ``within`` keeps rows whose columns lie between two bounds, both included (None: open). It reaches the
    parquet scan, which a later filter on a double column cannot, since the column is cleaned in between.
    Null and NaN lie within no bounds.
    """
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    df = reader.parquet(f"{folder}/{name}.parquet")
    for column, (low, high) in (within or {}).items():
        if low is not None:
            df = df.filter(F.col(column) >= F.lit(low))
        if high is None and isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
            high = float("inf")  # NaN is above it
        df = df.filter(F.col(column) <= F.lit(high)) if high is not None else df.filter(F.col(column).isNotNull())
    return nan_as_null(df)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Plain CSV with a header. Unreadable numbers become null, and so does NaN."""
    df = spark.read.schema(schema).option("header", True).option("nanValue", "NaN").csv(path)
    return nan_as_null(df)


def read_csv_after_preamble(spark: SparkSession, path: str, schema: T.StructType, skip_lines: int = 3) -> DataFrame:
    """CSV whose header comes after ``skip_lines`` other lines, blank ones included, in each file.

    These lines and the header go by their position, whatever they hold, and every later line that is
    not blank is a row; an unreadable field, the date too, becomes null. The lines of the block at the
    start of a file are read in order by one task, so their ids follow each other: a line's position is its
    id less the least id of that block. The least ids, one for each file, come from a second scan in the
    same plan, which therefore cuts the files in the same way; it reads no fields, and no line is written.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    first = lines.groupBy("file").agg(F.min(F.when(F.col("start") == 0, F.col("id"))).alias("first"))
    rows = lines.join(first, "file", "left").filter((F.col("start") > 0) | (F.col("id") - F.col("first") > skip_lines))
    parsed = rows.filter(F.trim("value") != "").select(F.from_csv("value", _ddl(schema)).alias("row"))
    return nan_as_null(parsed.select("row.*"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def nan_as_null(df: DataFrame) -> DataFrame:
    """Missing is null from here on: NaN would be counted and averaged as a value."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[nan_to_null(f"`{c}`").alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def parse_date(x: Column | str, strict: bool = False, fmt: str | None = None) -> Column:
    """Text to date. Strict parsing fails the job on bad text; otherwise bad text becomes null."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    column = F.col(x) if isinstance(x, str) else x
    return (parse(column, F.lit(fmt) if fmt and not strict else fmt) if fmt else parse(column)).cast("date")


def numeric_or_null(x: Column | str) -> Column:
    column = F.col(x) if isinstance(x, str) else x
    return column.cast("string").try_cast("double")


def sanitize_times(df: DataFrame) -> DataFrame:
    """Every text or time column named like a date or time becomes a timestamp cut to the second; a
    number of such a name (``runtime``) stays a number."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        timely = isinstance(field.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
        if timely and ("date" in field.name.lower() or "time" in field.name.lower()):
            stamp = F.try_to_timestamp(column) if isinstance(field.dataType, T.StringType) else column
            column = F.date_trunc("second", stamp.cast("timestamp_ntz")).cast("timestamp_ntz").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def load_bundle(tables: Mapping[str, DataFrame], keep: bool = False) -> dict[str, DataFrame]:
    """The source tables under their names, times parsed; ``keep`` holds them for repeated use."""
    ready = {name: sanitize_times(df) for name, df in tables.items()}
    return {name: df.persist() if keep else df for name, df in ready.items()}
