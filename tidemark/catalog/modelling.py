"""Model jobs. Boosted models stop by patience on the validation rows.

The library defaults are the published sizes; ``quick`` gives larger steps, fewer rounds and trees, so that
a run of all queries stays short.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.base import daily_sql, query, r, rounded
from tidemark.catalog.features import SITE_AIR, SITE_POLLEN, aqi_table, pollen_log_table, two_stage_table
from tidemark.catalog.scans import scratch_path
from tidemark.functions.scalars import aqi_band, jitter_normal, pollen_level
from tidemark.models import clusters as K
from tidemark.models import linear as L
from tidemark.models import trees as T
from tidemark.models.blends import fit_two_stage, mean_of, two_stage_predict
from tidemark.models.boosting import at_once
from tidemark.models.prepare import Matrix, matrix, predict_with
from tidemark.models.registry import (
    MODELS, Settings, air_fits, load_bundle, load_model, load_saved, save_bundle, save_model, selected_fit, with_stop,
)
from tidemark.models.tuning import halving
from tidemark.operators import metrics as E
from tidemark.operators import splits as P
from tidemark.operators import stats as G
from tidemark.operators.ordering import top_k
from tidemark.operators.smooth import knee_point
from tidemark.plans import features as X
from tidemark.plans.scalar_stats import constants
from tidemark.plans.scratch import written
from tidemark.sources import daily

KEYS = ["site", "date"]


def quick(how: T.Boosting) -> T.Boosting:
    return replace(how, rounds=40, step=0.2, patience=5)


FOREST = T.Forest(trees=60, depth=8)
PUBLISHED = Settings(keys=("site",), test_from=2000, val_year=1999)
SETTINGS = replace(
    PUBLISHED, forest=FOREST, log_forest=replace(T.LOG_FOREST, trees=60, depth=12),
    **{name: quick(getattr(PUBLISHED, name)) for name in ("depth_wise", "leaf_wise", "past_boosting", "log_boosting", "mixture", "spikes", "levels")},
)
SCORES = ["mae", "mse", "rmse", "r2"]
WEATHER = ["temp", "rain", "apparent", "gust", "wind", "wind_dir"]


def air_data(spark: SparkSession, folder: str, scale: bool = False) -> Matrix:
    """53 features, built within each split, as a matrix."""
    built = aqi_table(spark, folder, within_split=True)
    names = X.feature_names(built, SITE_AIR)
    return matrix(built, names, "aqi", scale=scale, train_splits=("train", "val"))


def scored(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*KEYS, *cols)


# ---- linear models ---------------------------------------------------------------------------

TWO = ["temp", "rain"]
MOMENTS = (
    "m AS (SELECT var_pop(temp) AS a, var_pop(rain) AS b, covar_pop(temp, rain) AS c, covar_pop(temp, total) AS d, "
    "covar_pop(rain, total) AS e, avg(temp) AS ma, avg(rain) AS mb, avg(total) AS my, CAST(count(*) AS DOUBLE) AS n FROM all_three "
    "WHERE year(date) < 2000)"
)


def two_feature_train(spark: SparkSession, folder: str, scale: bool = False) -> Matrix:
    parts = P.split_by_year(daily.all_three(spark, folder).select(*KEYS, *TWO, "total"), 2000)
    return matrix(parts, TWO, "total", scale=scale)


@query(
    "linear_regression",
    daily_sql(
        """
SELECT unnest(['temp', 'rain', 'intercept']) AS term, round(unnest([w1, w2, my - w1 * ma - w2 * mb]), 5) AS weight
FROM (SELECT *, (d * b - c * e) / (a * b - c * c) AS w1, (a * e - c * d) / (a * b - c * c) AS w2 FROM m)
""",
        MOMENTS,
    ),
)
def linear_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients of total pollen on temperature and rain, over the train rows."""
    data = two_feature_train(spark, folder)
    return rounded(L.coefficients(L.fit_ols(data.train, data.label), data.names, data.table), 5, "weight")


@query(
    "ridge",
    daily_sql(
        """
SELECT unnest(['temp', 'rain', 'intercept']) AS term, round(unnest([w1, w2, my]), 5) AS weight FROM (
  SELECT my, (z1 * (1 + k) - q * z2) / ((1 + k) * (1 + k) - q * q) AS w1, (z2 * (1 + k) - q * z1) / ((1 + k) * (1 + k) - q * q) AS w2
  FROM (SELECT my, d / sqrt(a) AS z1, e / sqrt(b) AS z2, c / sqrt(a * b) AS q, 1 / n AS k FROM m))
""",
        MOMENTS,
    ),
)
def ridge(spark: SparkSession, folder: str) -> DataFrame:
    """Alpha 1 on features standardized over the train rows."""
    data = two_feature_train(spark, folder, scale=True)
    return rounded(L.coefficients(L.fit_ridge(data.train, data.label, 1.0), data.names, data.table), 5, "weight")


@query("ridge_aqi")
def ridge_aqi(spark: SparkSession, folder: str) -> DataFrame:
    """Ridge on all 53 features, train and validation rows, scored on test rows."""
    data = air_data(spark, folder, scale=True)
    fitted = L.fit_ridge(data.part("train", "val"), data.label, 1.0)
    return E.regression_metrics(predict_with(fitted, data.part("test")), "aqi", "predicted")


@query("lasso")
def lasso(spark: SparkSession, folder: str) -> DataFrame:
    data = air_data(spark, folder, scale=True)
    fitted = L.fit_lasso(data.part("train", "val"), data.label, 0.01)
    return E.regression_metrics(predict_with(fitted, data.part("test")), "aqi", "predicted")


@query("harmonic_regression")
def harmonic_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Three fits on all rows: pollen on season; pollen on season and weather; air quality on
    pollutants and weather. One row of metrics each."""
    joined = daily.stored(daily.all_three(spark, folder))
    first = constants(joined, {"y": F.min(F.year("date"))})["y"]
    seasonal = ["day_sin", "day_cos", "day_sin2", "day_cos2", "year_normalized"]
    base = joined.select("*", *X.harmonic_columns("date", first), F.lit("train").alias("split"))
    fits = {
        "pollen_season": ("total", seasonal),
        "pollen_season_weather": ("total", [*seasonal, "temp", "rain", "wind"]),
        "aqi_pollutants_weather": ("aqi", ["pm25", "o3", "co", "no2", "so2", "temp", "rain", "wind"]),
    }
    results = []
    for name, (target, names) in fits.items():
        data = matrix(base, names, target)
        table = predict_with(L.fit_ols(data.train, target), data.train)
        results.append(E.regression_metrics(table, target, "predicted").withColumn("fit", F.lit(name)))
    return P.union_splits(*results)


@query("weather_baseline")
def weather_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Air quality from same-day weather: linear model and forest, last fifth of each series as test."""
    parts = P.split_fraction(daily.air_weather(spark, folder).select(*KEYS, "aqi", *WEATHER), 0.2, ["site"])
    data = matrix(parts, WEATHER, "aqi")
    fits = {"linear": L.fit_ols(data.train, "aqi"), "forest": T.fit_forest(data.train, "aqi", FOREST)}
    tables = [predict_with(m, data.table).select("split", "aqi", "predicted", F.lit(n).alias("fit")) for n, m in fits.items()]
    return E.regression_metrics(P.union_splits(*tables), "aqi", "predicted", ["fit", "split"])


# ---- trees -----------------------------------------------------------------------------------


@query("rf_regressor")
def rf_regressor(spark: SparkSession, folder: str) -> DataFrame:
    data = air_data(spark, folder)
    fitted = T.fit_forest(data.part("train", "val"), "aqi", FOREST)
    return scored(predict_with(fitted, data.part("test")), "aqi", "predicted")


@query("rf_log_target")
def rf_log_target(spark: SparkSession, folder: str) -> DataFrame:
    """Forest with at least four rows per leaf on the log target, taken back by expm1."""
    return load_model("pollen_forest").predict(tables_of(spark, folder), SETTINGS)


@query("gbt_regressor")
def gbt_regressor(spark: SparkSession, folder: str) -> DataFrame:
    """Boosting that stops on the validation year."""
    data = air_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.depth_wise)
    return scored(predict_with(T.fit_boosted(rows, "aqi", how), data.part("test")), "aqi", "predicted")


@query("gbt_leaf_wise")
def gbt_leaf_wise(spark: SparkSession, folder: str) -> DataFrame:
    """About 31 leaves per tree: depth 5, smaller steps."""
    data = air_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.leaf_wise)
    return scored(predict_with(T.fit_boosted(rows, "aqi", how), data.part("test")), "aqi", "predicted")


@query("early_stop_curve")
def early_stop_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Validation loss after every round that was tried, and the rounds that were kept: a regressor by the
    root mean square error, a spike classifier by 1 - area under the ROC curve."""
    air, spikes = air_data(spark, folder), spike_data(spark, folder)
    rows, how = with_stop(air, SETTINGS.depth_wise)
    spike_rows, spike_how = with_stop(spikes, SETTINGS.spikes)
    fits = at_once([
        lambda: T.staged_fit(rows, "aqi", how),
        lambda: T.staged_fit(spike_rows, "is_spike", spike_how, loss="auc"),
    ])
    curves = [fit.curve(rows).withColumn("fit", F.lit(name)) for name, fit in zip(("aqi_rmse", "spike_auc"), fits)]
    return P.union_splits(*curves)


def log_data(spark: SparkSession, folder: str) -> Matrix:
    built = pollen_log_table(spark, folder)
    names = [c for c in X.feature_names(built, SITE_POLLEN) if c not in ("total_capped", "log_total")]
    return matrix(built, names, "log_total")


@query("gbt_weighted")
def gbt_weighted(spark: SparkSession, folder: str) -> DataFrame:
    data = log_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.log_boosting)
    fitted = T.fit_boosted(rows, "log_total", how, "weight")
    table = predict_with(fitted, data.part("test")).withColumn("predicted", F.expm1("predicted"))
    return scored(table, "total", "predicted")


@query("importance_select")
def importance_select(spark: SparkSession, folder: str) -> DataFrame:
    """Features that split often in a first weighted fit, and the metrics of the second fit."""
    data = log_data(spark, folder)
    kept, fitted = selected_fit(data, SETTINGS.log_boosting, "weight")
    table = predict_with(fitted, T.keep_features(data.part("test"), kept)).withColumn("predicted", F.expm1("predicted"))
    names = F.array(*[F.lit(data.names[i]) for i in sorted(kept)])
    return E.regression_metrics(table, "total", "predicted").withColumn("kept", F.array_join(names, ","))


@query("split_counts")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many nodes each feature splits in the trees of a weighted fit."""
    data = log_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.log_boosting)
    fitted = T.fit_boosted(rows, "log_total", how, "weight")
    return T.split_counts(fitted, data.names, spark).select("feature", "splits")


@query("level_classifier")
def level_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Class-weighted boosted levels of three pollen types: observed and forecast."""
    return load_model("pollen_levels").predict(tables_of(spark, folder), SETTINGS)


@query("level_report")
def level_report(spark: SparkSession, folder: str) -> DataFrame:
    table = written(load_model("pollen_levels").predict(tables_of(spark, folder), SETTINGS))
    reports = [
        E.classification_report(table, f"{k}_observed", f"{k}_forecast", list(range(5))).withColumn("kind", F.lit(k))
        for k in ("tree", "grass", "weed")
    ]
    return P.union_splits(*reports)


@query("level_scatter")
def level_scatter(spark: SparkSession, folder: str) -> DataFrame:
    """Observed and forecast levels with a little normal noise, so that points do not cover each other."""
    table = load_model("pollen_levels").predict(tables_of(spark, folder), SETTINGS)
    return scored(
        table,
        jitter_normal("tree_observed", KEYS, 42).alias("observed"),
        jitter_normal("tree_forecast", KEYS, 43).alias("forecast"),
    )


def spike_data(spark: SparkSession, folder: str) -> Matrix:
    """The ratio defines the label, so it is left out of the features."""
    built = two_stage_table(spark, folder, year_lag=False)
    skip = {"spike_z", "is_spike", "target_asinh", "ratio_1d_7d", "temp", "wind", "rain"}
    names = [c for c in X.feature_names(built, SITE_POLLEN) if c not in skip]
    return matrix(built, names, "target_asinh", missing="median")


@query("spike_classifier")
def spike_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Spike probability, scored by the area under the ROC curve on validation and test rows."""
    data = spike_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.spikes)
    table = T.with_probability(T.fit_spike_classifier(rows, how=how), data.part("val", "test"), "p")
    return E.roc_auc(table.select("split", "is_spike", "p"), "is_spike", "p", ["split"])


@query("two_stage_mixture")
def two_stage_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """All three fits stop on the validation year; scored on test rows."""
    data = spike_data(spark, folder)
    rows, how = with_stop(data, SETTINGS.mixture)
    models = fit_two_stage(rows, how=how, classifier=with_stop(data, SETTINGS.spikes)[1])
    return scored(two_stage_predict(models, data.part("test")), "total", "spike_probability", "predicted")


def ensemble_table(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("test",)) -> DataFrame:
    data = air_data(spark, folder)
    return mean_of(air_fits(data, SETTINGS), data.part(*splits))


@query("ensemble_mean")
def ensemble_mean(spark: SparkSession, folder: str) -> DataFrame:
    return scored(ensemble_table(spark, folder), "aqi", "predicted")


@query("ensemble_metrics_by_split")
def ensemble_metrics_by_split(spark: SparkSession, folder: str) -> DataFrame:
    """Fit rows next to test rows, to see overfitting."""
    table = ensemble_table(spark, folder, ("train", "val", "test"))
    part = F.when(F.col("split") == "test", "test").otherwise("fit")
    return E.regression_metrics(table.withColumn("part", part), "aqi", "predicted", ["part"])


@query("ensemble_band_metrics")
def ensemble_band_metrics(spark: SparkSession, folder: str) -> DataFrame:
    table = ensemble_table(spark, folder)
    bands = table.select(aqi_band("aqi").alias("band"), aqi_band("predicted").alias("said"))
    return E.classification_report(bands, "band", "said", list(range(5)))


@query("refit_train_val")
def refit_train_val(spark: SparkSession, folder: str) -> DataFrame:
    """Test error of a fit on train rows against a refit on train and validation rows."""
    data = air_data(spark, folder)
    tables = [
        predict_with(T.fit_forest(data.part(*parts), "aqi", FOREST), data.part("test"))
        .select("aqi", "predicted", F.lit("+".join(parts)).alias("fitted_on"))
        for parts in (("train",), ("train", "val"))
    ]
    return E.regression_metrics(P.union_splits(*tables), "aqi", "predicted", ["fitted_on"])


@query("tune_on_val")
def tune_on_val(spark: SparkSession, folder: str) -> DataFrame:
    """24 settings of a forest by successive halving on the validation year, best first; the test rows stay
    untouched."""
    data = air_data(spark, folder)
    grid = [
        replace(FOREST, depth=depth, min_leaf=leaf, subset=subset)
        for depth in (4, 6, 8, 10)
        for leaf in (1, 4, 16)
        for subset in ("auto", "all")
    ]

    def loss(how: T.Forest, trees: int) -> float:
        fitted = T.fit_forest(data.train, "aqi", replace(how, trees=trees))
        return E.regression_metrics(predict_with(fitted, data.part("val")), "aqi", "predicted").first()["rmse"]

    trials = halving(grid, loss, (5, 15, 45))
    rows = [(i, t.budget, t.setting.depth, t.setting.min_leaf, t.setting.subset, t.loss) for i, t in enumerate(trials, 1)]
    return spark.createDataFrame(rows, "place int, trees int, depth int, min_leaf int, subset string, rmse double")


@query("feature_importance")
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """The 15 most important features, least first."""
    data = air_data(spark, folder)
    fitted = T.fit_forest(data.train, "aqi", FOREST)
    return top_k(T.importances(fitted, data.names, data.table), "importance", 15, "feature")


@query("model_save_load")
def model_save_load(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a fitted model and of its saved copy."""
    data = air_data(spark, folder)
    path = scratch_path(spark, "model")
    fitted = T.fit_forest(data.train, "aqi", FOREST)
    save_model(fitted, path)
    both = predict_with(load_saved(path), predict_with(fitted, data.part("test")), "predicted_loaded")
    return scored(both, "predicted", "predicted_loaded")


@query("model_bundle")
def model_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Three fitted models stored as one bundle, loaded by name and scored without a refit: test rows and the
    largest difference from the models that were stored."""
    data, path = air_data(spark, folder), scratch_path(spark, "bundle")
    rows, how = with_stop(data, SETTINGS.depth_wise)
    fitted = {
        "forest": T.fit_forest(data.train, "aqi", replace(FOREST, trees=50)),
        "boosted": T.fit_boosted(rows, "aqi", how),
        "linear": L.fit_ols(data.train, "aqi"),
    }
    save_bundle(spark, fitted, path, data.names)
    loaded = load_bundle(spark, path)
    tables = [
        predict_with(loaded.model(name), predict_with(m, data.part("test")), "again").select(
            F.lit(name).alias("model"), F.abs(F.col("predicted") - F.col("again")).alias("difference")
        )
        for name, m in fitted.items()
    ]
    return P.union_splits(*tables).groupBy("model").agg(F.count("*").alias("n"), F.max("difference").alias("difference"))


# ---- registry --------------------------------------------------------------------------------


def tables_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "pollutants": daily.air(spark, folder),
        "weather": daily.weather(spark, folder),
        "pollen": daily.pollen(spark, folder),
    }


@query("model_registry")
def model_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Every registered numeric forecast model on the same tables: test error per model."""
    tables = {name: written(df) for name, df in tables_of(spark, folder).items()}
    results = [
        MODELS[name].predict(tables, SETTINGS).select("observed", "predicted", F.lit(name).alias("model"))
        for name in sorted(MODELS)
        if name != "pollen_levels"  # its levels are scored by level_report
    ]
    return E.regression_metrics(P.union_splits(*results), "observed", "predicted", ["model"])


# ---- clusters and components -----------------------------------------------------------------

CLUSTER_COLS = ["aqi", "total", "temp", "rain", "wind"]


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return K.scaled_vectors(daily.all_three(spark, folder).select(*KEYS, *CLUSTER_COLS), CLUSTER_COLS)


@query("kmeans_clusters")
def kmeans_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return scored(K.with_cluster(vectors(spark, folder), 3), "cluster")


@query("kmeans_feature_clusters")
def kmeans_feature_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Four clusters of yesterday's pollutants and weather, and today's index per cluster as a box."""
    cols = [f"{c}_lag1" for c in ("pm25", "o3", "no2", "so2", "co", "temp", "wind", "rain")]
    labelled = K.with_cluster(K.scaled_vectors(aqi_table(spark, folder).select(*KEYS, "aqi", *cols), cols), 4)
    return G.box_stats(written(labelled.select("cluster", "aqi")), "aqi", ["cluster"])


@query("cluster_profile")
def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    return K.cluster_profile(K.with_cluster(vectors(spark, folder), 3), CLUSTER_COLS)


# Feature sets and their numbers of clusters, without and with month and day.
CLUSTER_SETS = {
    "weather_pollen": ([*WEATHER, "total"], 17, 18),
    "weather_aqi": ([*WEATHER, "aqi"], 14, 14),
    "aqi_pollen": (["aqi", "total"], 11, 12),
}


def cluster_table(spark: SparkSession, folder: str) -> DataFrame:
    days = daily.all_three(spark, folder).select(*KEYS, *WEATHER, "total", "aqi")
    return daily.stored(days.withColumns({"month": F.month("date").cast("double"), "day": F.dayofmonth("date").cast("double")}))


@query("elbow_costs")
def elbow_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Cost of every k from 1 to 99 for three feature sets, and whether it is the knee of its curve."""
    days, parts = cluster_table(spark, folder), []
    for name, (cols, _, _) in CLUSTER_SETS.items():
        costs = K.elbow_costs(K.scaled_vectors(days, cols), range(1, 100))
        knee = knee_point(costs).first()["k"]
        parts.append(rounded(costs, 3, "cost").withColumns({"features": F.lit(name), "knee": F.col("k") == knee}))
    return P.union_splits(*parts)


@query(
    "elbow_single",
    daily_sql(
        "SELECT unnest(['weather_pollen', 'weather_aqi', 'aqi_pollen']) AS features, "
        "round(unnest([7e0, 7e0, 2e0]) * count(*), 3) AS cost FROM all_three"
    ),
)
def elbow_single(spark: SparkSession, folder: str) -> DataFrame:
    """The cost of one cluster: rows times features, since every feature has unit variance."""
    days, parts = cluster_table(spark, folder), []
    for name, (cols, _, _) in CLUSTER_SETS.items():
        costs = K.elbow_costs(K.scaled_vectors(days, cols), [1])
        parts.append(costs.select(F.lit(name).alias("features"), r("cost", "cost", 3)))
    return P.union_splits(*parts)


@query("kmeans_profiles")
def kmeans_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and mean of every feature per cluster: three feature sets, without and with month and day, for
    three clusters and for the published numbers."""
    days, parts = cluster_table(spark, folder), []
    for name, (cols, plain, dated) in CLUSTER_SETS.items():
        for with_dates, most in ((False, plain), (True, dated)):
            used = [*cols, "month", "day"] if with_dates else cols
            table = K.scaled_vectors(days, used)
            centres, _ = K.fit_together(table, [3, most])
            for k, found in centres.items():
                profile = K.cluster_profile(K.with_nearest(table, found), used)
                means = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(f"mean_{c}", 6).alias("mean")) for c in used])
                long = profile.select("cluster", "n", F.inline(means))
                parts.append(long.withColumns({"features": F.lit(name), "with_dates": F.lit(with_dates), "k": F.lit(k)}))
    return P.union_splits(*parts)


@query("pca_2d")
def pca_2d(spark: SparkSession, folder: str) -> DataFrame:
    return K.two_components(vectors(spark, folder), KEYS)


@query(
    "pca_variance",
    daily_sql("SELECT round(1 + abs(corr(temp, gust)), 5) AS var_pc1, round(1 - abs(corr(temp, gust)), 5) AS var_pc2 FROM weather"),
)
def pca_variance(spark: SparkSession, folder: str) -> DataFrame:
    """Variance along both components of two standardized columns: 1 +- their correlation."""
    pair = K.scaled_vectors(daily.weather(spark, folder).select(*KEYS, "temp", "gust"), ["temp", "gust"])
    parts = K.two_components(pair, KEYS)
    return parts.agg(r(F.var_pop("pc1"), "var_pc1", 5), r(F.var_pop("pc2"), "var_pc2", 5))


@query("level_counts", daily_sql(
    "SELECT lv, count(*) AS n FROM (SELECT CASE WHEN tree < 1 THEN 0 WHEN tree <= 14 THEN 1 WHEN tree <= 89 THEN 2 "
    "WHEN tree <= 1499 THEN 3 ELSE 4 END AS lv FROM pollen) GROUP BY lv"
))
def level_counts(spark: SparkSession, folder: str) -> DataFrame:
    levels = daily.pollen(spark, folder).select(pollen_level("tree", "tree").alias("lv"))
    return G.value_counts(levels, "lv")
