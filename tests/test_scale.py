"""Plans for long series and skewed data: same values as the plain operator, however rows are cut."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.scalars import nan_to_null
from tidemark.operators import metrics as E
from tidemark.operators import smooth as K
from tidemark.operators import splits as P
from tidemark.operators import stats as G
from tidemark.operators import windows as W
from tidemark.plans import longseries as S
from tidemark.plans.ranking import narrowed_quantiles, quantiles, quantiles_of_ranked, ranked_counts
from tidemark.plans.scratch import scratch_root


@pytest.fixture(scope="module")
def long_frame():
    """3,000 readings, most of them of one series, with a 600-row gap."""
    rng = np.random.default_rng(3)
    n = 3000
    series = np.where(rng.random(n) < 0.7, "hot", np.where(rng.random(n) < 0.5, "b", "c"))
    x = rng.normal(size=n).round(3)
    x[1000:1600] = np.nan
    x[0] = np.nan
    return pd.DataFrame({"id": np.arange(n), "series": series, "x": x})


def frame(spark, pdf):
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1), "id long, series string, x double")
    return df.withColumn("x", nan_to_null("x"))


@pytest.mark.parametrize("keys", [[], ["series"]])
@pytest.mark.parametrize("chunk", [30, 400, 100_000])
@pytest.mark.parametrize("partitions", [1, 7])
def test_chunked_windows(spark, long_frame, keys, chunk, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = S.over_chunks(
            frame(spark, long_frame), keys, ["id"],
            lambda w: [W.lag("x", 30, w).alias("lag30"), W.rolling_mean("x", 7, w).alias("m7"), F.lead("x", 2).over(w).alias("lead2")],
            back=30, ahead=2, chunk_rows=chunk,
        ).orderBy("id").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    groups = long_frame.groupby("series")["x"] if keys else long_frame.assign(one=1).groupby("one")["x"]
    assert len(got) == len(long_frame)
    np.testing.assert_allclose(got["lag30"].astype(float), groups.shift(30))
    np.testing.assert_allclose(got["m7"].astype(float), groups.transform(lambda s: s.shift(1).rolling(7).mean()), atol=1e-9)
    np.testing.assert_allclose(got["lead2"].astype(float), groups.shift(-2))


@pytest.mark.parametrize("keys", [[], ["series"]])
@pytest.mark.parametrize("chunk", [17, 400])
def test_unbounded_carries(spark, long_frame, keys, chunk):
    groups = long_frame.groupby("series")["x"] if keys else long_frame.assign(one=1).groupby("one")["x"]
    filled = S.forward_fill_long(frame(spark, long_frame), keys, ["id"], "x", chunk_rows=chunk).orderBy("id").toPandas()
    np.testing.assert_allclose(filled["x"].astype(float), groups.ffill())
    lined = S.interpolate_long(frame(spark, long_frame), keys, ["id"], "x", chunk_rows=chunk).orderBy("id").toPandas()
    np.testing.assert_allclose(lined["x"].astype(float), groups.transform(lambda s: s.interpolate()), atol=1e-9)


def test_row_numbers_and_split(spark, long_frame):
    numbered = S.index_rows(frame(spark, long_frame), [], ["id"]).orderBy("id").toPandas()
    assert list(numbered["_rn"]) == list(range(len(long_frame)))
    sizes = P.split_fraction_rows(frame(spark, long_frame), ["id"], 0.2).groupBy("split").count().toPandas()
    assert dict(zip(sizes["split"], sizes["count"])) == {"train": 2400, "test": 600}


def test_hot_value_and_hot_group(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.where(rng.random(5000) < 0.8, "hot", "cold"), "v": rng.integers(0, 400, 5000) * 1.0})
    pdf.loc[rng.random(5000) < 0.4, "v"] = 42.0
    df = spark.createDataFrame(pdf)
    got = ranked_counts(df, "v", ["g"]).toPandas().sort_values(["g", "v"])
    pdf["rank"] = pdf.groupby("g")["v"].rank()
    want = pdf.drop_duplicates(["g", "v"]).sort_values(["g", "v"])
    np.testing.assert_allclose(got["n_before"] + (got["n"] + 1) / 2, want["rank"])
    q = quantiles(df, "v", {"m": 0.5, "p": 0.95}, ["g"]).toPandas().set_index("g").sort_index()
    np.testing.assert_allclose(q[["m", "p"]], pdf.groupby("g")["v"].quantile([0.5, 0.95]).unstack())


@pytest.mark.parametrize("by", [[], ["g"]])
def test_narrowed_quantiles_are_exact(spark, by):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": np.where(rng.random(60_000) < 0.8, "hot", "cold"), "v": rng.normal(size=60_000).round(4)})
    pdf.loc[rng.random(60_000) < 0.35, "v"] = 0.25
    probs = {"lo": 0.0, "a": 0.25, "b": 0.2501, "m": 0.5, "p": 0.999, "hi": 1.0}
    got = narrowed_quantiles(spark.createDataFrame(pdf).repartition(6), "v", probs, by)
    assert got is not None
    want = pdf.groupby("g")["v"].quantile(list(probs.values())).unstack() if by else pdf["v"].quantile(list(probs.values()))
    table = got.toPandas()
    table = table.set_index("g").sort_index() if by else table
    np.testing.assert_allclose(table[list(probs)].to_numpy().ravel(), want.to_numpy().ravel(), atol=1e-12)


def test_narrowed_quantiles_leave_most_rows_behind(spark):
    df = spark.range(200_000).select(F.hash("id").cast("double").alias("v"))
    sizes = []
    import tidemark.plans.ranking as ranking

    original = ranking.rank_counted
    ranking.rank_counted = lambda counts, *a, **k: (sizes.append(counts.count()), original(counts, *a, **k))[1]
    try:
        assert quantiles(df, "v", {"m": 0.5, "p": 0.95}).count() == 1
    finally:
        ranking.rank_counted = original
    assert sizes[0] < 2_000


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    whole = quantiles_of_ranked(ranked_counts(df, "v", ["g"]), "v", {"m": 0.5}, ["g"])
    for table in (quantiles(df, "v", {"m": 0.5}, ["g"]), whole):
        assert {r.g: r.m for r in table.collect()} == {None: 2.0, "a": 5.0}


def test_density_sends_sums_only(spark):
    plan = K.kernel_density(spark.range(1000).select((F.col("id") / 7).alias("x")), "x")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(point" in plan and "hashpartitioning(x" not in plan


def test_auc_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 200)
    s = (rng.normal(size=200) + y).round(1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    gap = s[y == 1][:, None] - s[y == 0][None, :]
    want = (gap > 0).mean() + 0.5 * (gap == 0).mean()
    assert E.roc_auc(df, "y", "s").first().auc == pytest.approx(want)


def test_lowess_against_direct_fit(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=150), np.zeros(100)]).round(2)
    y = x**2 + rng.normal(size=250)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = K.lowess(df, "x", "y", 0.5, 9, robust=0).orderBy("point").toPandas()
    k = int(np.ceil(0.5 * len(x)))
    for point, at, fitted in got.itertuples(index=False):
        d = np.abs(x - at)
        h = np.sort(d)[k - 1]
        w = np.clip(1 - (d / h) ** 3, 0, None) ** 3 if h > 0 else (d == 0).astype(float)
        if h > 0 and np.sum(w > 0) > 1:
            a = np.vstack([np.ones_like(x), x - at]).T * np.sqrt(w)[:, None]
            want = np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0][0]
            assert fitted == pytest.approx(want, abs=1e-6), point


def _robust_curve(x, y, fraction, points, rounds):
    grid = np.linspace(x.min(), x.max(), points)
    k = max(int(np.ceil(fraction * len(x))), 2)
    trust = np.ones_like(y)
    for turn in range(rounds + 1):
        fitted = []
        for at in grid:
            d = x - at
            h = np.sort(np.abs(d))[k - 1]
            w = np.clip(1 - (np.abs(d) / h) ** 3, 0, None) ** 3 * trust
            a = np.vstack([np.ones_like(x), d]).T * np.sqrt(w)[:, None]
            fitted.append(np.linalg.lstsq(a, y * np.sqrt(w), rcond=None)[0][0])
        gap = np.abs(y - np.interp(x, grid, fitted))
        trust = np.clip(1 - (gap / (6 * np.median(gap))) ** 2, 0, None) ** 2
    return np.array(fitted)


def test_robust_lowess_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(-2, 3, 400)
    y = np.sin(2 * x) + rng.normal(size=400) * 0.2
    table = lambda y: spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    curve = K.lowess(table(y), "x", "y", points=12).orderBy("point").toPandas()["fitted"].to_numpy()
    np.testing.assert_allclose(curve, _robust_curve(x, y, 2 / 3, 12, 3), atol=1e-9)
    moved = y.copy()
    moved[np.argsort(x)[200]] += 1e4
    after = K.lowess(table(moved), "x", "y", points=12).orderBy("point").toPandas()["fitted"].to_numpy()
    assert np.abs(after - curve).max() < 0.02
    assert np.abs(_robust_curve(x, moved, 2 / 3, 12, 0) - curve).max() > 10  # without robust rounds it moves


def test_robust_lowess_edges(spark):
    table = lambda rows: spark.createDataFrame(rows, "x double, y double")
    assert K.lowess(table([]), "x", "y").count() == 0
    assert {r["fitted"] for r in K.lowess(table([(1.0, 2.0)] * 5 + [(None, 1.0)]), "x", "y", points=3).collect()} == {2.0}
    line = K.lowess(table([(float(i), 3.0 * i) for i in range(30)] + [(10.0, 99.0)]), "x", "y", points=7).collect()
    assert all(abs(r["fitted"] - 3 * r["x"]) < 1e-6 for r in line)


def test_correlations_by_products(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd")).assign(b=lambda t: 1e6 + t["a"] * 0.5 + t["b"], k=0.1)
    holes = pdf.mask(rng.random(pdf.shape) < 0.2).assign(never=np.nan)
    df = spark.createDataFrame(holes.astype(object).where(holes.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in holes.columns))
    got = G.pearson(df.repartition(7), list(holes.columns)).toPandas().pivot(index="var_a", columns="var_b")
    want = holes.corr(min_periods=2)
    order = list(holes.columns)
    for a in "abcd":
        np.testing.assert_allclose(got["r"].loc[a, list("abcd")], want.loc[a, list("abcd")], atol=1e-9)
    assert got["r"].loc["k"].drop("k").isna().all() and got["r"].loc["never"].drop("never").isna().all()
    present = holes.notna().astype(int)
    assert (got["n"].loc[order, order].to_numpy() == (present.T @ present).to_numpy()).all()
    assert G.pearson(df.filter("false"), ["a", "b"]).filter("var_a <> var_b and r is null and n = 0").count() == 2


def test_ranks_in_place(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": range(900), "a": rng.integers(0, 5, 900).astype(float), "b": rng.normal(size=900), "c": 1.0})
    df = spark.createDataFrame(pdf).repartition(6)
    got = G.with_ranks(df, ["a", "b", "c"], ["id"]).toPandas().set_index("id").sort_index()
    pd.testing.assert_frame_equal(got, pdf.set_index("id").rank(), check_names=False)
    plan = G.with_ranks(df, ["a", "b", "c"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # values too many to be broadcast: the rows move once for each column
        large = G.with_ranks(df, ["a", "b", "c"], ["id"])
        assert large.orderBy("id").toPandas()["b"].tolist() == got["b"].tolist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_correlations_do_not_multiply_rows(spark, folder, tmp_path):
    """The plan behind the products has neither a row per pair nor a shuffle of rows."""
    values = spark.range(1000).select(*[(F.rand(i) * 10).alias(f"c{i}") for i in range(30)])
    values.write.parquet(str(tmp_path / "v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("products", "products")
    try:
        G.pearson(spark.read.parquet(str(tmp_path / "v")), values.columns)
        stages = [s for j in tracker.getJobIdsForGroup("products") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(set(stages)) <= 8


def test_density_has_unit_mass(spark):
    df = spark.createDataFrame([(float(v),) for v in np.random.default_rng(1).normal(size=500)], "x double")
    curve = K.kernel_density(df, "x", 200).orderBy("x").toPandas()
    assert 0.97 < np.trapezoid(curve["density"], curve["x"]) < 1.01


def test_box_against_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 600), "v": np.exp(rng.normal(size=600))})
    got = G.box_stats(spark.createDataFrame(pdf), "v", ["g"]).toPandas().set_index("g").sort_index()
    for g, s in pdf.groupby("g")["v"]:
        a, b = s.quantile(0.25), s.quantile(0.75)
        inside = s[(s >= a - 1.5 * (b - a)) & (s <= b + 1.5 * (b - a))]
        assert got.loc[g, "whisker_low"] == inside.min() and got.loc[g, "whisker_high"] == inside.max()
        assert got.loc[g, "n_outliers"] == len(s) - len(inside)


def test_features_do_not_look_ahead(spark):
    start = dt.date(2020, 1, 1)
    rows = [(1, start + dt.timedelta(days=i), float((i * 37) % 101)) for i in range(60)]
    w = W.series_window(["site"])

    def build(part):
        df = spark.createDataFrame(part, "site int, date date, x double")
        picked = [*W.lags("x", [1, 7], w), *W.rolling_means("x", [3, 7], w), W.weighted_past("x", w).alias("wp")]
        return {r.date: r for r in df.select("date", *picked).collect()}

    early, full = build(rows[:40]), build(rows)
    assert all(early[d] == full[d] for d in early)


def test_scaler_and_weights(spark):
    df = spark.createDataFrame([(float(i % 7), i % 3) for i in range(100)], "x double, y int")
    z = G.standardized(df, ["x"]).agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert z.m == pytest.approx(0, abs=1e-12) and z.s == pytest.approx(1)
    total = G.with_class_weight(df, "y", [0, 1, 2], df).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(100)


def test_written_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    import tidemark.plans.scratch as scratch

    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path))
    table = scratch.written(spark.range(5))
    assert table.count() == 5 and list(tmp_path.iterdir())
    (tmp_path / "other").mkdir()
    scratch.drop_written(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_cluster_needs_a_shared_folder(spark):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    Session.conf.get = staticmethod(lambda key, default: "hdfs://shared/scratch/")
    assert scratch_root(Session()) == "hdfs://shared/scratch"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lengths=st.lists(st.integers(1, 40), min_size=1, max_size=4),
    chunk=st.integers(5, 60),
    lag=st.integers(1, 12),
    holes=st.integers(2, 9),
)
def test_any_cut_gives_the_plain_result(spark, lengths, chunk, lag, holes):
    """Series of any length, cut anywhere: lag and forward fill as pandas has them."""
    rows = [(s, i, None if (s + i) % holes == 0 else float(i * 7 % 11)) for s, n in enumerate(lengths) for i in range(n)]
    df = spark.createDataFrame(rows, "s int, i int, x double")
    pdf = pd.DataFrame(rows, columns=["s", "i", "x"]).astype({"x": float})
    lagged = S.over_chunks(df, ["s"], ["i"], lambda w: [W.lag("x", lag, w).alias("l")], back=lag, chunk_rows=chunk)
    got = lagged.orderBy("s", "i").toPandas()["l"].astype(float)
    np.testing.assert_allclose(got, pdf.groupby("s")["x"].shift(lag))
    filled = S.forward_fill_long(df, ["s"], ["i"], "x", chunk_rows=chunk).orderBy("s", "i").toPandas()["x"].astype(float)
    np.testing.assert_allclose(filled, pdf.groupby("s")["x"].ffill())
