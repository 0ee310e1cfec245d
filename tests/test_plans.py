"""What the planner makes of the queries."""

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.plans import features as X
from tidemark.plans import longseries as S
from tidemark.operators import windows as W
from tidemark.sources import daily
from tidemark.sources.readers import read_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_share_one_sort(spark, folder):
    table = daily.stored(daily.air_weather(spark, folder))
    plan = plan_of(X.aqi_features(table, X.Columns(keys=("site",), target="aqi", pairs=X.AIR.pairs)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("name", ["aqi_features", "pollen_features", "corr_spearman", "raw_lags", "roc_auc", "kde"])
def test_no_python_in_the_plan(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["aqi_features", "quantiles", "corr_pearson", "histogram", "kde", "lowess_grid", "fill_mean"])
def test_no_cross_join(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["join_three_way", "join_fold"])
def test_orders_are_scanned_once_at_most(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_totalprice") <= 2 * plan.count("Relation") and plan.count("Relation [o_orderkey") <= 1


def test_date_bound_reaches_the_scan(spark, folder):
    plan = plan_of(QUERIES["date_range_filter"](spark, folder))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_custkey" not in plan


def test_bounds_on_doubles_reach_the_scan(spark, folder, tmp_path):
    cut = read_table(spark, folder, "lineitem", within={"l_quantity": (None, 3), "l_discount": (0.02, None)})
    filters = plan_of(cut.select("l_orderkey")).split("PushedFilters: ")[1]
    assert "LessThanOrEqual(l_quantity,3.0)" in filters and "GreaterThanOrEqua" in filters
    assert cut.count() == read_table(spark, folder, "lineitem").filter("l_quantity <= 3 and l_discount >= 0.02").count() > 0
    spark.createDataFrame([(1.0,), (float("nan"),), (None,), (9.0,)], "x double").write.parquet(str(tmp_path / "t.parquet"))
    for bounds, want in (((None, None), [1, 9]), ((2, None), [9]), ((None, 2), [1]), ((1, 9), [1, 9])):
        assert sorted(r.x for r in read_table(spark, str(tmp_path), "t", within={"x": bounds}).collect()) == want


def test_only_needed_columns_are_read(spark, folder):
    plan = plan_of(QUERIES["group_mean"](spark, folder))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_shipdate:timestamp_ntz>" in plan


def test_long_series_windows_are_partitioned(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    plan = plan_of(S.over_chunks(events, [], ["ts", "event_id"], lambda w: W.lags("value", [1], w), back=1))
    windows = [line for line in plan.splitlines() if "Window [lag(" in line]
    assert windows and all("_chunk" in line for line in windows)


def test_daily_grain_has_one_row_per_key(spark, folder):
    for table in (daily.air, daily.weather, daily.pollen, daily.all_three):
        df = table(spark, folder)
        assert df.groupBy("site", "date").count().filter(F.col("count") > 1).isEmpty()
