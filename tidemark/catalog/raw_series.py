"""Window features on raw records, where a series has no bound on its length.

The event stream by type and the orders as one single series stand for the hard case: the plain
window would place a series in one task. Order keys end in an id, so the order is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import query, r, rounded
from tidemark.functions.scalars import flag
from tidemark.operators import splits as P
from tidemark.operators import windows as W
from tidemark.plans import longseries as S
from tidemark.plans.ranking import average_rank, ranked_counts
from tidemark.sources.readers import read_table

EVENT_ORDER = ["ts", "event_id"]
ORDER_ORDER = ["o_orderdate", "o_orderkey"]


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("event_id", "ts", "event_type", "value")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "raw_lags",
    "SELECT event_id, lag(value, 1) OVER s AS value_lag1, lag(value, 7) OVER s AS value_lag7, lag(value, 30) OVER s AS value_lag30 "
    "FROM events WINDOW s AS (PARTITION BY event_type ORDER BY ts, event_id)",
)
def raw_lags(spark: SparkSession, folder: str) -> DataFrame:
    built = S.over_chunks(
        events(spark, folder), ["event_type"], EVENT_ORDER, lambda w: W.lags("value", [1, 7, 30], w), back=30
    )
    return built.select("event_id", "value_lag1", "value_lag7", "value_lag30")


def _roll(n: int) -> str:
    frame = f"(ORDER BY o_orderdate, o_orderkey ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count(o_totalprice) OVER {frame} = {n} THEN avg(o_totalprice) OVER {frame} END, 3) AS o_totalprice_roll{n}"


@query(
    "raw_single_series",
    "SELECT o_orderkey, lag(o_totalprice, 1) OVER (ORDER BY o_orderdate, o_orderkey) AS o_totalprice_lag1, "
    f"{_roll(7)}, {_roll(30)}, coalesce(lag(o_totalprice, 1) OVER (ORDER BY o_orderdate, o_orderkey) > "
    "avg(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), false)::INTEGER AS is_spike "
    "FROM orders",
)
def raw_single_series(spark: SparkSession, folder: str) -> DataFrame:
    """All orders are one series."""
    built = S.over_chunks(
        orders(spark, folder),
        [],
        ORDER_ORDER,
        lambda w: [
            W.lag("o_totalprice", 1, w).alias("o_totalprice_lag1"),
            *W.rolling_means("o_totalprice", [7, 30], w),
            flag(W.lag("o_totalprice", 1, w) > W.rolling_mean("o_totalprice", 7, w, strict=False)).alias("is_spike"),
        ],
        back=30,
    ).drop("o_orderdate", "o_totalprice")
    return rounded(built, 3, "o_totalprice_roll7", "o_totalprice_roll30")


GAPS = "(SELECT event_id, ts, event_type, CASE WHEN hour(ts) >= 6 THEN value END AS value FROM events)"


def night_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """No readings before six in the morning: long runs of missing values."""
    return events(spark, folder).withColumn("value", F.when(F.hour("ts") >= 6, F.col("value")))


@query(
    "raw_forward_fill",
    "SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {GAPS}",
)
def raw_forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    return S.forward_fill_long(night_gaps(spark, folder), ["event_type"], EVENT_ORDER, "value").select("event_id", "value")


@query(
    "raw_interpolate",
    f"""
SELECT event_id, round(CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                            ELSE pv + (nv - pv) * (rn - pr) / (nr - pr) END, 9) AS value
FROM (SELECT *, last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS pr,
             first_value(value IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN value IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS nr
      FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM {GAPS})
      WINDOW b AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
""",
)
def raw_interpolate(spark: SparkSession, folder: str) -> DataFrame:
    """All events are one series."""
    filled = S.interpolate_long(night_gaps(spark, folder), [], EVENT_ORDER, "value")
    return filled.select("event_id", r("value", "value", 9))


@query(
    "raw_row_numbers",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders",
)
def raw_row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    numbered = S.index_rows(orders(spark, folder), [], ORDER_ORDER)
    return numbered.select("o_orderkey", F.col("_rn").alias("position"))


@query(
    "raw_split_fraction",
    "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= "
    "count(*) OVER () - ceil(0.2::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM orders",
)
def raw_split_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return P.split_fraction_rows(orders(spark, folder), ORDER_ORDER, 0.2).select("o_orderkey", "split")


@query(
    "raw_average_ranks",
    "SELECT DISTINCT l_returnflag, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + "
    "(count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2e0 AS avg_rank FROM lineitem",
)
def raw_average_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of heavily tied values: each value is counted before anything is ordered."""
    lines = read_table(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    ranked = ranked_counts(lines, "l_quantity", ["l_returnflag"])
    return ranked.select("l_returnflag", "l_quantity", average_rank().alias("avg_rank"))
