"""Model jobs against closed forms and direct computation."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.catalog.modelling import SETTINGS, tables_of
from tidemark.models import clusters as K
from tidemark.models import linear as L
from tidemark.models import trees as T
from tidemark.models.blends import fit_two_stage, mean_of, two_stage_predict
from tidemark.models.prepare import matrix, predict_with
from tidemark.models.registry import MODELS, load_bundle, load_model, load_saved, save_bundle, save_model
from tidemark.plans.scratch import written
from tidemark.operators.metrics import regression_metrics

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2] + [0, 10, -3]
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + 0.01 * x[:, 2] + rng.normal(size=300)
    split = np.where(np.arange(300) < 220, "train", np.where(np.arange(300) < 250, "val", "test"))
    return pd.DataFrame({"id": np.arange(300), **dict(zip(NAMES, x.T)), "y": y, "split": split, "spiky": (x[:, 0] > 1).astype(int)})


@pytest.fixture(scope="module")
def data(spark, pdf):
    return matrix(spark.createDataFrame(pdf), NAMES, "y")


@pytest.fixture(scope="module")
def scaled(spark, pdf):
    return matrix(spark.createDataFrame(pdf), NAMES, "y", scale=True)


def train_arrays(pdf, scale):
    t = pdf[pdf.split == "train"]
    x = t[NAMES].to_numpy()
    if scale:
        x = (x - x.mean(0)) / x.std(0)
    return x, t["y"].to_numpy()


def test_ols(data, pdf):
    model = L.fit_ols(data.train, "y")
    x, y = train_arrays(pdf, False)
    want = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
    np.testing.assert_allclose([model.intercept, *model.coefficients], want, atol=1e-6)


def test_ridge_and_lasso(scaled, pdf):
    x, y = train_arrays(pdf, True)
    yc = y - y.mean()
    ridge = np.linalg.solve(x.T @ x + np.eye(3), x.T @ yc)
    np.testing.assert_allclose(L.fit_ridge(scaled.train, "y", 1.0).coefficients, ridge, atol=1e-8)
    alpha = 0.1
    w = np.zeros(3)
    for _ in range(2000):  # coordinate descent on |y - xw|^2 / 2n + alpha |w|
        for j in range(3):
            rho = x[:, j] @ (yc - x @ w + x[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (x[:, j] @ x[:, j] / len(y))
    np.testing.assert_allclose(L.fit_lasso(scaled.train, "y", alpha).coefficients, w, atol=1e-5)


def test_forest_importances_and_selection(data):
    model = T.fit_forest(data.train, "y", T.Forest(trees=10, depth=4))
    table = T.importances(model, data.names, data.table).toPandas()
    assert table["importance"].sum() == pytest.approx(1) and table["feature"][0] in ("a", "b")
    counts = {r["feature"]: r["splits"] for r in T.split_counts(model, data.names, data.table.sparkSession).collect()}
    kept = T.important_positions(model, data.names, data.table, splits=counts["c"])
    assert 2 not in kept and kept
    many = T.important_positions(model, data.names, data.table, splits=10**6, fallback=2)
    assert many == T.important_positions(model, data.names, data.table, splits=-1)[:2]
    sliced = T.keep_features(data.train, kept).select(vector_to_array("features").alias("v")).first()
    assert len(sliced.v) == len(kept)


def test_saved_model_predicts_the_same(spark, data, tmp_path):
    model = T.fit_forest(data.train, "y", T.Forest(trees=5, depth=4))
    save_model(model, str(tmp_path / "m"))
    both = predict_with(load_saved(str(tmp_path / "m")), predict_with(model, data.part("test")), "again")
    assert both.filter(F.col("predicted") != F.col("again")).count() == 0


def test_bundle_is_loaded_by_name_and_only_when_finished(spark, data, tmp_path):
    fitted = {"forest": T.fit_forest(data.train, "y", T.Forest(trees=5, depth=4)), "line": L.fit_ols(data.train, "y")}
    path = str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, path)
    save_bundle(spark, fitted, path, data.names)
    bundle = load_bundle(spark, path)
    assert set(bundle.kinds) == set(fitted) and bundle.features == data.names
    for name, model in fitted.items():
        both = predict_with(bundle.model(name), predict_with(model, data.part("test")), "again")
        assert both.filter(F.col("predicted") != F.col("again")).count() == 0
    with pytest.raises(KeyError):
        bundle.model("other")
    with pytest.raises(Exception, match="exists"):
        save_bundle(spark, fitted, path, data.names)
    with pytest.raises(ValueError):
        save_bundle(spark, {"../x": fitted["line"]}, path, data.names)


def test_mean_of_models(data):
    models = [T.fit_forest(data.train, "y", T.Forest(trees=3, depth=d)) for d in (2, 3, 4)]
    mean = mean_of(models, data.part("test")).orderBy("id").toPandas()["predicted"]
    parts = [predict_with(m, data.part("test")).orderBy("id").toPandas()["predicted"] for m in models]
    np.testing.assert_allclose(mean, sum(parts) / 3)


def test_two_stage_mixture(data):
    how = T.Boosting(rounds=3, depth=2, step=0.1, rows=1.0, subset="all", stop_on="held")
    rows = T.with_validation_flag(data.part("train", "val"), "held")
    models = fit_two_stage(rows, "y", "spiky", how)
    got = two_stage_predict(models, data.part("test")).orderBy("id").toPandas()
    p = T.with_probability(models[0], data.part("test"), "p").orderBy("id").toPandas()["p"]
    quiet, spiky = (predict_with(m, data.part("test")).orderBy("id").toPandas()["predicted"] for m in models[1:])
    np.testing.assert_allclose(got["predicted"], np.sinh(p * spiky + (1 - p) * quiet))


def test_weights_change_the_fit(data):
    how = T.Boosting(rounds=3, depth=2, step=0.3, rows=1.0, subset="all")
    weighted = data.train.withColumn("w", F.when(F.col("spiky") == 1, 10.0).otherwise(1.0))
    error = {}
    for weight in (None, "w"):
        table = predict_with(T.fit_boosted(weighted, "y", how, weight), weighted.filter("spiky = 1"))
        error[weight] = regression_metrics(table, "y", "predicted").first().mse
    assert error["w"] < error[None]


def test_missing_values_are_filled_and_flagged(spark, pdf):
    holes = pdf.assign(a=pdf["a"].where(pdf.id % 10 != 0))
    df = spark.createDataFrame(holes).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    filled = matrix(df, NAMES, "y", missing="median")
    assert filled.names == (*NAMES, "a_missing", "b_missing", "c_missing")
    first = filled.table.filter("id = 0").select(vector_to_array("features").alias("v")).first().v
    assert first[0] == pytest.approx(holes.loc[holes.split == "train", "a"].median()) and first[3] == 1.0
    assert matrix(df, NAMES, "y").table.count() == 270


@pytest.fixture(scope="module")
def vectors(spark, pdf):
    return K.scaled_vectors(spark.createDataFrame(pdf[["id", *NAMES]]), NAMES)


def test_clusters(vectors, pdf):
    z = pdf[NAMES].to_numpy()
    z = (z - z.mean(0)) / z.std(0)
    model = K.fit_clusters(vectors, 4)
    centres = np.array(model.clusterCenters())
    distance = ((z[:, None, :] - centres[None]) ** 2).sum(2)
    labels = K.with_cluster(vectors, 4).orderBy("id").toPandas()["cluster"]
    assert (labels.to_numpy() == distance.argmin(1)).all()
    assert K.assignment_cost(model, vectors) == pytest.approx(distance.min(1).sum())
    profile = K.cluster_profile(K.with_cluster(vectors, 4), NAMES).toPandas()
    whole = (profile["mean_a"] * profile["n"]).sum() / profile["n"].sum()
    assert whole == pytest.approx(pdf["a"].mean())
    costs = K.elbow_costs(vectors, range(1, 5)).toPandas()["cost"]
    assert costs[0] == pytest.approx((z**2).sum()) and costs.is_monotonic_decreasing


def test_all_numbers_of_clusters_together(vectors, pdf):
    z = pdf[NAMES].to_numpy()
    z = (z - z.mean(0)) / z.std(0)
    centres, costs = K.fit_together(vectors, range(1, 100))
    gaps = {k: ((z[:, None, :] - c[None]) ** 2).sum(2) for k, c in centres.items()}
    assert sorted(costs) == list(range(1, 100)) and all(len(c) == k for k, c in centres.items())
    for k in costs:
        assert costs[k] == pytest.approx(gaps[k].min(1).sum(), abs=1e-6)
        assert k == 1 or costs[k] <= costs[k - 1]
    # the centres have settled: each is the mean of its rows
    near = gaps[7].argmin(1)
    for j, centre in enumerate(centres[7]):
        np.testing.assert_allclose(centre, z[near == j].mean(0), atol=1e-3)
    labels = K.with_nearest(vectors, centres[7]).orderBy("id").toPandas()["cluster"].to_numpy()
    assert (labels == near).all()


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(float(i % 3), 0.5 * (i % 3)) for i in range(12)], "a double, b double")
    centres, costs = K.fit_together(K.scaled_vectors(df, ["a", "b"]), [1, 3, 5, 8])
    assert [len(centres[k]) for k in (1, 3, 5, 8)] == [1, 3, 3, 3]
    assert costs[3] == pytest.approx(0, abs=1e-9) and costs[8] <= costs[5] <= costs[3] < costs[1]
    with pytest.raises(ValueError):
        K.fit_together(K.scaled_vectors(df, ["a", "b"]).filter("a > 9"), [1, 2])


def test_components(vectors, pdf):
    z = pdf[NAMES].to_numpy()
    z = (z - z.mean(0)) / z.std(0)
    values, axes = np.linalg.eigh(np.cov(z.T))
    want = np.abs(z @ axes[:, ::-1][:, :2])
    got = K.two_components(vectors, ["id"]).orderBy("id").toPandas()
    np.testing.assert_allclose(np.abs(got[["pc1", "pc2"]].to_numpy()), want, atol=1e-6)


def test_registry(spark, folder):
    tables = {name: written(df) for name, df in tables_of(spark, folder).items()}
    assert len(MODELS) == 9 and all(entry.short_description for entry in MODELS.values())
    with pytest.raises(KeyError):
        load_model("unknown")
    small = load_model("aqi_forest").predict(tables, replace(SETTINGS, forest=T.Forest(trees=10, depth=4)))
    assert small.columns == ["site", "date", "observed", "predicted"]
    row = regression_metrics(small, "observed", "predicted").first()
    assert row.n > 0 and np.isfinite(row.rmse)
