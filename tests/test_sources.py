"""Readers, names, guards and sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names as N
from tidemark.operators import clean as C
from tidemark.operators import splits as P
from tidemark.plans import scratch
from tidemark.sources import readers as R
from tidemark.sources import sinks as K


def test_csv_behind_a_preamble(spark, tmp_path):
    lines = ["latitude,longitude", "2019,-71.1", "", "time,temp (C),rain", "2020-01-01,1.5,0.0", "2020-13-01,9,9", "", "2020-01-02,NaN,", "none,8,8"]
    (tmp_path / "w.csv").write_text("\n".join(lines))
    schema = T.StructType([T.StructField("time", T.DateType()), T.StructField("temp (C)", T.DoubleType()), T.StructField("rain", T.DoubleType())])
    rows = R.read_csv_after_preamble(spark, str(tmp_path / "w.csv"), schema).orderBy("time", "rain").collect()
    assert [tuple(r) for r in rows] == [(None, 8.0, 8.0), (None, 9.0, 9.0), (dt.date(2020, 1, 1), 1.5, 0.0), (dt.date(2020, 1, 2), None, None)]


def test_preambles_of_several_split_files(spark, tmp_path):
    for n in range(3):
        lines = ["a,b", "2019,1", "", "time,x", *["2019,1"] * 5, *[f"2020-01-01,{n * 1000 + i}" for i in range(1000)]]
        (tmp_path / f"{n}.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = R.read_csv_after_preamble(spark, str(tmp_path), T.StructType.fromDDL("time string, x int"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = df.groupBy("time").agg(F.count("*").alias("n"), F.sum("x").alias("sum")).orderBy("time").collect()
    assert [tuple(r) for r in rows] == [("2019", 15, 15), ("2020-01-01", 3000, 2999 * 3000 // 2)]


def test_preamble_lines_are_not_copied(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("h\n\n\nx\n" + "".join(f"{i}\n" for i in range(50)))
    monkeypatch.setattr(scratch, "written_at", None)
    df = R.read_csv_after_preamble(spark, str(tmp_path), T.StructType.fromDDL("x int"))
    assert df.agg(F.sum("x"), F.count("*")).first() == (1225, 50)
    scans = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line]
    assert len(scans) == 2 and all(str(tmp_path) in f for f in df.inputFiles())


def test_plain_csv_with_odd_names(spark, tmp_path):
    (tmp_path / "p.csv").write_text("date,PM2.5,O3\n2020-01-01,3.5,x\n2020-01-02,,2\n")
    df = R.read_csv(spark, str(tmp_path / "p.csv"), "date string, `PM2.5` double, O3 double")
    rows = N.with_clean_names(df).orderBy("date").collect()
    assert [(r.pm2_5, r.o3) for r in rows] == [(3.5, None), (None, 2.0)]


def test_csv_and_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.25), (dt.date(2021, 1, 1), None)], "date date, x double")
    K.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, R.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == sorted(map(tuple, df.collect()))
    K.write_parquet(df, str(tmp_path / "p"), by_year_of="date")
    read = spark.read.parquet(str(tmp_path / "p")).filter(F.col("year_of") == 2021)
    assert read.count() == 1 and "PartitionFilters: [isnotnull(year_of" in read._jdf.queryExecution().toString()


def test_bundle_cuts_times_to_the_second(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00.75", 1), ("nothing", 2)], "time string, x int")
    rows = R.load_bundle({"weather": df})["weather"].orderBy("x").collect()
    assert rows[0].time == dt.datetime(2020, 1, 1, 10, 0, 0) and rows[1].time is None


@pytest.mark.parametrize(
    "style, want",
    [("basic", "temp_2m_°C/h"), ("no_degree", "temp_2m_C/h"), ("no_slash", "temp_2m_°C_h"), ("standard", "temp_2m__h")],
)
def test_name_styles(style, want):
    assert N.clean_name("temp 2m (°C/h)", style) == want


def test_standard_names_lose_trailing_underscores():
    assert N.clean_name(" Temperature_2m_mean (°C) ") == "temperature_2m_mean"
    assert N.clean_name("PM2.5") == "pm2_5"


def test_equal_names_are_refused(spark):
    with pytest.raises(ValueError):
        N.with_clean_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))


def test_guards(spark):
    df = spark.createDataFrame([("2020-01-01",), (None,)], "date string").withColumn("date", F.col("date").cast("date"))
    with pytest.raises(ValueError):
        C.require_columns(df, ["target"])
    with pytest.raises(ValueError):
        C.require_columns(df, [])
    with pytest.raises(ValueError):
        C.require_rows(df.filter(F.lit(False)), "test")
    with pytest.raises(Exception, match="unparsed value"):
        C.require_parsed(df, "date").collect()
    assert N.resolve_strict(df, ["date"]) == ["date"]
    with pytest.raises(ValueError):
        N.resolve_strict(df, ["datum"])


def test_strict_dates_fail(spark):
    df = spark.createDataFrame([("2020-13-01",)], "d string")
    assert df.select(R.parse_date("d").alias("d")).first().d is None
    with pytest.raises(Exception):
        df.select(R.parse_date("d", strict=True)).collect()


def test_overlapping_splits_are_refused(spark):
    df = spark.createDataFrame([("train", 5), ("test", 3)], "split string, date int")
    with pytest.raises(ValueError):
        P.assert_no_leakage(df)
    assert P.assert_no_leakage(df.filter("split = 'train'").unionByName(spark.createDataFrame([("test", 9)], "split string, date int")))


def test_numbers_named_like_times_stay(spark):
    from tidemark.sources.readers import sanitize_times

    df = spark.createDataFrame([(1.5, "2020-01-02 03:04:05")], "runtime double, date string")
    assert [t for _, t in sanitize_times(df).dtypes] == ["double", "timestamp_ntz"]


def test_value_counts_keep_values_outside_the_list(spark):
    from tidemark.operators.stats import value_counts

    df = spark.createDataFrame([(5,), (70,), (-1,)], "x bigint")
    counts = {r["x"]: r["n"] for r in value_counts(df, "x", spark.range(10).withColumnRenamed("id", "x")).collect()}
    assert sum(counts.values()) == 3 and counts[70] == 1 and counts[0] == 0


def test_nan_in_parquet_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "p_partkey bigint, p_retailprice double")
    df.write.parquet(str(tmp_path / "part.parquet"))
    rows = {r.p_partkey: r.p_retailprice for r in R.read_table(spark, str(tmp_path), "part").collect()}
    assert rows == {1: None, 2: 1.5}
