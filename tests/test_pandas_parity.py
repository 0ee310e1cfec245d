"""Operators against the public pandas behaviour on small frames with missing values."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import clean as C
from tidemark.operators import joins as J
from tidemark.operators import labels as L
from tidemark.operators import resample as M
from tidemark.operators import splits as P
from tidemark.operators import stats as G
from tidemark.operators import windows as W
from tidemark.plans.ranking import quantiles


def days(n, start="2020-01-01"):
    return [d.date() for d in pd.date_range(start, periods=n)]


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(7)
    x = rng.normal(50, 20, 60).round(2)
    for gap in (0, 5, 6, 20, 41, 58, 59):
        x[gap] = np.nan
    return pd.DataFrame({"site": 1, "date": days(60), "x": x})


@pytest.fixture(scope="module")
def panel(series):
    other = pd.DataFrame({"site": 2, "date": days(35, "2020-03-01"), "x": np.arange(35.0)})
    return pd.concat([series, other], ignore_index=True)


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf.astype({"x": "float64"}), "site int, date date, x double")
    return df.withColumn("x", S.nan_to_null("x"))


def check(spark, pdf, columns, expected):
    got = (
        to_spark(spark, pdf)
        .select("site", "date", *[c.alias(n) for n, c in columns.items()])
        .orderBy("site", "date")
        .toPandas()
    )
    for name in columns:
        want = pd.concat([expected[name](g["x"]) for _, g in pdf.groupby("site")]).to_numpy(dtype=float)
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), want, rtol=1e-9, atol=1e-9, err_msg=name)


def test_window_features(spark, panel):
    w = W.series_window(["site"])
    columns, want = {}, {}
    for k in (1, 2, 7, 30):
        columns[f"lag{k}"], want[f"lag{k}"] = W.lag("x", k, w), lambda s, k=k: s.shift(k)
        columns[f"fill{k}"] = W.lag_filled("x", k, w)
        want[f"fill{k}"] = lambda s, k=k: s.shift(k).ffill()
    for n in (2, 3, 7, 14):
        columns[f"strict{n}"] = W.rolling_mean("x", n, w)
        want[f"strict{n}"] = lambda s, n=n: s.shift(1).rolling(n).mean()
        columns[f"relaxed{n}"] = W.rolling_mean("x", n, w, strict=False)
        want[f"relaxed{n}"] = lambda s, n=n: s.shift(1).rolling(n, min_periods=1).mean()
    for k in range(4):
        columns[f"sum{k}"], want[f"sum{k}"] = W.rolling_sum("x", k, w), lambda s, k=k: s.rolling(k + 1).sum()
    columns["diff7"], want["diff7"] = W.lag_diff("x", 1, 7, w), lambda s: s.shift(1) - s.shift(7)
    columns["past"] = W.weighted_past("x", w)
    want["past"] = lambda s: 0.1 * s.shift(3).ffill() + 0.3 * s.shift(2).ffill() + 0.6 * s.shift(1).ffill()
    columns["now"] = W.weighted_current("x", w)
    want["now"] = lambda s: 0.1 * s.shift(2) + 0.3 * s.shift(1) + 0.6 * s
    check(spark, panel, columns, want)


def test_pct_change_and_ratio(spark, panel):
    w = W.series_window(["site"])

    def safe(a, b):
        return (a / b.where(b != 0)).astype(float)

    check(
        spark,
        panel,
        {"pct7": W.pct_change("x", 7, w), "ratio": W.spike_ratio("x", w), "eps": W.spike_ratio("x", w, 7, False, 1e-8)},
        {
            "pct7": lambda s: safe(s.shift(1) - s.shift(7), s.shift(7)),
            "ratio": lambda s: safe(s.shift(1), s.shift(1).rolling(7).mean()),
            "eps": lambda s: safe(s.shift(1), s.shift(1).rolling(7, min_periods=1).mean() + 1e-8),
        },
    )


def test_ratio_with_zero_mean(spark):
    pdf = pd.DataFrame({"site": 1, "date": days(9), "x": [0.0] * 8 + [4.0]})
    w = W.series_window(["site"])
    got = to_spark(spark, pdf).select(W.spike_ratio("x", w).alias("r")).collect()
    assert all(row.r is None for row in got)


def test_rolling_then_forward_fill(spark, panel):
    w = W.series_window(["site"])
    built = to_spark(spark, panel).select("site", "date", W.rolling_mean("x", 3, w).alias("m"))
    got = built.select("site", "date", W.forward_filled("m", w).alias("m")).orderBy("site", "date").toPandas()
    want = pd.concat([g["x"].shift(1).rolling(3).mean().ffill() for _, g in panel.groupby("site")])
    np.testing.assert_allclose(got["m"].to_numpy(dtype=float), want.to_numpy())


def test_fills(spark, panel):
    df = to_spark(spark, panel)

    def values(filled):
        return filled.orderBy("site", "date").toPandas()["x"].to_numpy(dtype=float)

    groups = [g["x"] for _, g in panel.groupby("site")]
    np.testing.assert_allclose(values(C.interpolate(df, ["x"], ["site"])), pd.concat([g.interpolate().fillna(0) for g in groups]))
    np.testing.assert_allclose(values(C.forward_fill_zero(df, ["x"], ["site"])), pd.concat([g.ffill().fillna(0) for g in groups]))
    np.testing.assert_allclose(values(C.fill_mean(df, ["x"])), panel["x"].fillna(panel["x"].mean()))
    np.testing.assert_allclose(values(C.fill_zero(df, ["x"])), panel["x"].fillna(0))
    split = df.withColumn("split", F.when(F.col("site") == 2, "train").otherwise("test"))
    median = panel.loc[panel.site == 2, "x"].median()
    np.testing.assert_allclose(values(C.fill_train_median(split, ["x"]).select("site", "date", "x")), panel["x"].fillna(median))


def test_quantiles(spark, panel):
    probs = {"a": 0.0, "b": 0.25, "c": 0.75, "d": 0.95, "e": 1.0}
    got = quantiles(to_spark(spark, panel), "x", probs, ["site"]).toPandas().set_index("site").sort_index()
    want = panel.groupby("site")["x"].quantile(list(probs.values())).unstack()
    np.testing.assert_allclose(got[list(probs)].to_numpy(), want.to_numpy())


def test_describe_and_spearman(spark, panel):
    pdf = panel.assign(y=panel["x"].round(-1), z=np.arange(len(panel)) % 7 * 1.0)
    df = spark.createDataFrame(pdf, "site int, date date, x double, y double, z double")
    df = df.withColumns({c: S.nan_to_null(c) for c in "xyz"})
    got = G.describe(df, ["x", "z"]).toPandas().set_index("variable")
    want = pdf[["x", "z"]].describe().T
    np.testing.assert_allclose(got.loc[["x", "z"], ["mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float),
                               want[["mean", "std", "min", "25%", "50%", "75%", "max"]])
    matrix = G.spearman(df, ["x", "y", "z"], ["site", "date"]).toPandas().pivot(index="var_a", columns="var_b", values="r")
    # pandas alone has no rank correlation without scipy: correlate average ranks
    ranks = pdf[["x", "y", "z"]].dropna().rank()
    np.testing.assert_allclose(matrix.loc[list("xyz"), list("xyz")].to_numpy(), ranks.corr().to_numpy(), atol=1e-12)
    pairwise = G.pearson(df, ["x", "y", "z"]).toPandas().pivot(index="var_a", columns="var_b", values="r")
    np.testing.assert_allclose(pairwise.loc[list("xyz"), list("xyz")].to_numpy(), pdf[["x", "y", "z"]].corr().to_numpy(), atol=1e-12)


@pytest.mark.parametrize("n_train", [0, 3, 8])
def test_spike_threshold_fallbacks(spark, n_train):
    x = [3.0, 9.0, 4.0, 20.0, 1.0, 7.0, 30.0, 2.0, 5.0, 6.0]
    pdf = pd.DataFrame({"site": 1, "date": days(10), "x": x})
    split = F.when(F.dayofyear("date") <= n_train, "train").otherwise("test")
    df = to_spark(spark, pdf).withColumn("split", split)
    got = df.select(L.mean_std_threshold("x", ["site"]).alias("t")).first().t
    train = pd.Series(x[:n_train])
    if n_train >= 5:
        want = train.mean() + train.std()
    elif n_train:
        want = train.median() + train.std()
    else:
        want = pd.Series(x).median()
    assert got == pytest.approx(want)


def test_labels_use_train_rows_only(spark):
    """Changing test rows changes no threshold, score or cap of the train rows."""
    base = [float((i * 13) % 17) for i in range(40)]
    results = []
    for factor in (1.0, 50.0):
        x = base[:30] + [v * factor for v in base[30:]]
        df = to_spark(spark, pd.DataFrame({"site": 1, "date": days(40), "x": x}))
        df = df.withColumn("split", F.when(F.dayofyear("date") <= 30, "train").otherwise("test"))
        keys = ["site"]
        picked = df.select(
            "date",
            L.train_quantile("x", 0.95, keys).alias("q"),
            L.z_score("x", keys).alias("z"),
            L.winsorized("x", keys).alias("w"),
            L.mean_std_threshold("x", keys).alias("t"),
        )
        results.append([tuple(r) for r in picked.orderBy("date").limit(30).collect()])
    assert results[0] == results[1]


def test_row_lags_and_day_lags_differ_over_a_season_gap(spark):
    dates = [d.date() for d in pd.date_range("2019-01-01", "2021-12-31") if 3 <= d.month <= 10]
    pdf = pd.DataFrame({"site": 1, "date": dates, "x": np.arange(len(dates), dtype=float)})
    df = to_spark(spark, pdf)
    w = W.series_window(["site"])
    first_march = dt.date(2020, 3, 1)
    by_row = df.select("date", W.lag("x", 1, w).alias("l")).filter(F.col("date") == F.lit(first_march)).first().l
    full = W.on_calendar(df, ["site"])
    by_day = full.select("date", W.lag("x", 1, w).alias("l")).filter(F.col("date") == F.lit(first_march)).first().l
    assert by_row == dates.index(dt.date(2019, 10, 31)) and by_day is None


def test_right_closed_bins(spark):
    values = [0.0, 0.5, 1.0, 5.0, 100.0, 101.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(S.bin_label("x", S.RAIN_EDGES).alias("b"), S.bin_label("x", S.RAIN_EDGES, True).alias("low")).collect()
    assert [r.b for r in rows] == [None, "(0, 1]", "(0, 1]", "(1, 5]", "(20, 100]", None, None]
    assert rows[0].low == "(0, 1]"
    cut = pd.cut(pd.Series(values, dtype=float), S.RAIN_EDGES).astype(str).replace("nan", None)
    assert [r.b for r in rows] == list(cut.where(cut.notna(), None))


def test_levels_and_bands(spark):
    df = spark.createDataFrame([(v,) for v in [0.5, 1.0, 14.0, 15.0, 89.0, 90.0, 1499.0, 1500.0]], "x double")
    assert [r[0] for r in df.select(S.pollen_level("x", "tree")).collect()] == [0, 1, 1, 2, 2, 3, 3, 4]
    bands = spark.createDataFrame([(v,) for v in [50.0, 50.1, 150.0, 200.0, 201.0, None, float("nan")]], "x double")
    assert [r[0] for r in bands.select(S.aqi_band("x")).collect()] == [0, 1, 2, 3, 4, 4, 4]


def test_month_gap_is_kept(spark):
    pdf = pd.DataFrame({"site": 1, "date": [dt.date(2020, 1, 5), dt.date(2020, 1, 7), dt.date(2020, 3, 1)], "x": [1.0, 3.0, 5.0]})
    got = M.monthly_mean(to_spark(spark, pdf), ["x"], ["site"]).orderBy("month_end").collect()
    assert [(r.month_end, r.mean_x) for r in got] == [
        (dt.date(2020, 1, 31), 2.0), (dt.date(2020, 2, 29), None), (dt.date(2020, 3, 31), 5.0)
    ]


def test_full_outer_join_matches_null_keys(spark):
    a = spark.createDataFrame([("2020-01-01", 1), (None, 2)], "date string, a int")
    b = spark.createDataFrame([("2020-01-02", 3), (None, 4)], "date string, b int")
    got = {(r.date, r.a, r.b) for r in J.join_full_null_safe(a, b, ["date"]).collect()}
    assert got == {("2020-01-01", 1, None), ("2020-01-02", None, 3), (None, 2, 4)}


@pytest.mark.parametrize("end, sizes", [("2024-12-31", (5112, 365, 367)), ("2024-02-29", None)])
def test_relative_split(spark, end, sizes):
    dates = pd.date_range("2009-01-01", end)
    df = spark.createDataFrame(pd.DataFrame({"date": dates.date}), "date date")
    got = {r.split: r.n_rows for r in P.split_sizes(P.split_relative(df)).collect()}
    newest = dates.max()
    test_from, val_from = newest - pd.DateOffset(years=1), newest - pd.DateOffset(years=1) - pd.DateOffset(years=1)
    want = ((dates < val_from).sum(), ((dates >= val_from) & (dates < test_from)).sum(), (dates >= test_from).sum())
    assert (got["train"], got["val"], got["test"]) == want
    if sizes:
        assert want == sizes


def test_keyed_noise_is_the_same_under_any_layout(spark):
    df = spark.range(4000).select((F.col("id") % 7).alias("site"), F.col("id").alias("day"))
    noisy = lambda d: {(r.site, r.day): (r.u, r.n) for r in d.select("site", "day", S.uniform_noise(["site", "day"], 1).alias("u"), S.normal_noise(["site", "day"], 1).alias("n")).collect()}
    first = noisy(df.coalesce(1))
    assert first == noisy(df.repartition(13, "day").orderBy(F.desc("day")))
    u, n = np.array(list(first.values())).T
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.02 and abs(u.std() - 12**-0.5) < 0.01
    assert abs(n.mean()) < 0.05 and abs(n.std() - 1) < 0.05
    other = {r.day: r.u for r in df.select("day", S.uniform_noise(["site", "day"], 2).alias("u")).collect()}
    assert abs(np.corrcoef(u, [other[d] for _, d in first])[0, 1]) < 0.06
