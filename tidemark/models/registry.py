"""Named forecast models behind one contract: tables in, (keys, date, observed, predicted) out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import POLLEN_LEVEL_LIMITS, pollen_level
from tidemark.models import trees as T
from tidemark.models.blends import fit_two_stage, mean_of, two_stage_predict
from tidemark.models.boosting import at_once
from tidemark.models.prepare import Matrix, matrix, predict_with
from tidemark.operators.clean import varying_columns
from tidemark.operators.joins import join_all
from tidemark.operators.splits import split_by_year, split_relative
from tidemark.operators.stats import with_class_weight
from tidemark.plans import features as X
from tidemark.plans.scratch import written

Tables = Mapping[str, DataFrame]
MANIFEST = "name string, kind string, features array<string>"


@dataclass(frozen=True)
class Settings:
    """What the caller may change: series keys, split years, the season, and model sizes."""

    keys: tuple[str, ...] = ()
    test_from: int = 2023
    test_to: int | None = None
    val_year: int | None = None
    season: tuple[int, int] | None = None
    forest: T.Forest = T.Forest()
    depth_wise: T.Boosting = T.DEPTH_WISE
    leaf_wise: T.Boosting = T.LEAF_WISE
    log_forest: T.Forest = T.LOG_FOREST
    past_boosting: T.Boosting = T.DAILY_POLLEN
    log_boosting: T.Boosting = T.LOG_POLLEN
    mixture: T.Boosting = T.MIXTURE
    spikes: T.Boosting = T.SPIKE_CLASSIFIER
    levels: T.Boosting = T.LEVELS


@dataclass(frozen=True)
class Entry:
    short_description: str
    predict: Callable[[Tables, Settings], DataFrame]


MODELS: dict[str, Entry] = {}


def model(name: str, short_description: str):
    def add(predict):
        MODELS[name] = Entry(short_description, predict)
        return predict

    return add


def load_model(name: str) -> Entry:
    if name not in MODELS:
        raise KeyError(f"unknown model {name}; known: {sorted(MODELS)}")
    return MODELS[name]


def save_model(fitted, path: str) -> None:
    PipelineModel(stages=[fitted]).write().overwrite().save(path)


def load_saved(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class Bundle:
    """Stored models: where each lies, its class, and the names behind its feature vector."""

    path: str
    kinds: Mapping[str, str]
    features: tuple[str, ...]

    def model(self, name: str):
        """Load one model, ready to score."""
        if name not in self.kinds:
            raise KeyError(f"no model {name} in the bundle; it holds {sorted(self.kinds)}")
        return PipelineModel.load(f"{self.path}/models/{name}").stages[0]


def save_bundle(spark: SparkSession, fitted: Mapping[str, object], path: str, features: Sequence[str]) -> None:
    """Store several fitted models in one folder. The manifest is written last, so a bundle that was not
    finished cannot be loaded; a folder that holds a bundle already is an error."""
    for name, one in fitted.items():
        if not name.isidentifier():
            raise ValueError(f"{name!r} is no name for a model")
        PipelineModel(stages=[one]).write().save(f"{path}/models/{name}")
    rows = [(name, type(one).__name__, list(features)) for name, one in fitted.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{path}/manifest")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The manifest of a stored bundle. Models are loaded by name."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/_SUCCESS")
    if not mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark):
        raise FileNotFoundError(f"no finished bundle at {path}")
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()  # a row for each model
    return Bundle(path, {r["name"]: r["kind"] for r in rows}, tuple(rows[0]["features"]) if rows else ())


STOP = "is_validation"


def with_stop(data: Matrix, how: T.Boosting) -> tuple[DataFrame, T.Boosting]:
    """Rows to fit on, and settings that stop on the validation rows among them, if there are any."""
    rows = T.with_validation_flag(data.part("train", "val"), STOP)
    return (rows, replace(how, stop_on=STOP)) if not data.part("val").isEmpty() else (rows, how)


# ---- air quality: relative split, features over the whole series ------------------------------


def air_matrix(tables: Tables, settings: Settings) -> Matrix:
    keys = [*settings.keys, "date"]
    columns = replace(X.AIR, keys=settings.keys)
    joined = tables["pollutants"].join(tables["weather"], keys)
    built = X.aqi_features(split_relative(joined), columns)
    return matrix(built, X.feature_names(built, columns), columns.target)


def forecast_table(scored: DataFrame, settings: Settings, label: str) -> DataFrame:
    return scored.select(*settings.keys, "date", F.col(label).alias("observed"), "predicted")


def _air_model(fit: Callable[[DataFrame, str, Settings], Sequence]):
    def predict(tables: Tables, settings: Settings) -> DataFrame:
        data = air_matrix(tables, settings)
        return forecast_table(mean_of(fit(data, settings), data.part("test")), settings, data.label)

    return predict


def _boosted(data: Matrix, how: T.Boosting):
    """Rounds chosen on the validation rows, then a fit on train and validation rows."""
    rows, how = with_stop(data, how)
    return T.refit_boosted(rows, data.label, how) if how.stop_on else T.fit_boosted(rows, data.label, how)


def air_fits(data: Matrix, settings: Settings) -> list:
    """Two boosted models and a forest, fitted side by side."""
    rows = data.part("train", "val")
    return at_once([
        lambda: _boosted(data, settings.depth_wise),
        lambda: _boosted(data, settings.leaf_wise),
        lambda: T.fit_forest(rows, data.label, settings.forest),
    ])


model("aqi_depth_wise", "Boosted trees of fixed depth for the air quality index")(
    _air_model(lambda data, s: [_boosted(data, s.depth_wise)])
)
model("aqi_leaf_wise", "Boosted trees with 31 leaves, small steps")(
    _air_model(lambda data, s: [_boosted(data, s.leaf_wise)])
)
model("aqi_forest", "Random forest for the air quality index")(
    _air_model(lambda data, s: [T.fit_forest(data.part("train", "val"), data.label, s.forest)])
)
model("aqi_ensemble", "Mean of two boosted models and a forest")(_air_model(air_fits))


# ---- pollen: split by year --------------------------------------------------------------------


def pollen_source(tables: Tables, settings: Settings) -> DataFrame:
    keys = [*settings.keys, "date"]
    merged = join_all([tables["pollen"], tables["weather"], tables["pollutants"]], keys)
    if settings.season:
        merged = X.season_only(merged, *settings.season)
    return split_by_year(merged, settings.test_from, settings.test_to, settings.val_year)


RAW = {"aqi", "gust", "apparent", "wind_dir", *X.POLLEN.pollutants, *X.POLLEN.weather, *X.POLLEN.types}
DERIVED = {"total_capped", "log_total", "spike_z", "target_asinh"}


def _names(built: DataFrame, columns: X.Columns, also_skip: Sequence[str] = ()) -> list[str]:
    skip = RAW | DERIVED | set(also_skip)
    return [c for c in X.feature_names(built, columns) if c not in skip]


@model("pollen_forest", "Random forest on the log of total pollen")
def pollen_forest(tables: Tables, settings: Settings) -> DataFrame:
    columns = replace(X.POLLEN, keys=settings.keys)
    built = X.pollen_basic(pollen_source(tables, settings), columns).withColumn("log_target", F.log1p(columns.target))
    data = matrix(built, _names(built, columns, ["log_target"]), "log_target", missing="median")
    fitted = T.fit_forest(data.train, data.label, settings.log_forest)
    scored = predict_with(fitted, data.part("test")).withColumn("predicted", F.expm1("predicted"))
    return forecast_table(scored, settings, columns.target)


@model("pollen_boosted", "Boosted trees on forward-filled past values")
def pollen_boosted(tables: Tables, settings: Settings) -> DataFrame:
    columns = replace(X.POLLEN, keys=settings.keys)
    built = X.pollen_past_only(pollen_source(tables, settings), columns)
    data = matrix(built, _names(built, columns), columns.target)
    rows, how = with_stop(data, settings.past_boosting)
    fitted = T.fit_boosted(rows, data.label, how)
    return forecast_table(predict_with(fitted, data.part("test")), settings, columns.target)


def selected_fit(data: Matrix, how: T.Boosting, weight: str, splits: int = 50):
    """Weighted fit, choice of the features that split often, and a second fit on those alone: positions
    that were kept, and the second model."""
    rows, how = with_stop(data, how)
    first = T.fit_boosted(rows, data.label, how, weight)
    kept = T.important_positions(first, data.names, rows, splits)
    return kept, T.fit_boosted(T.keep_features(rows, kept), data.label, how, weight)


@model("pollen_log_boosted", "Spike-weighted boosted trees on the winsorized log, important features only")
def pollen_log_boosted(tables: Tables, settings: Settings) -> DataFrame:
    columns = replace(X.POLLEN, keys=settings.keys)
    built = X.pollen_log(pollen_source(tables, settings), columns)
    data = matrix(built, _names(built, columns), "log_total")
    kept, fitted = selected_fit(data, settings.log_boosting, "weight")
    scored = predict_with(fitted, T.keep_features(data.part("test"), kept))
    return forecast_table(scored.withColumn("predicted", F.expm1("predicted")), settings, columns.target)


LEVELS = list(range(5))


@model("pollen_levels", "Class-weighted boosted levels per pollen type")
def pollen_levels(tables: Tables, settings: Settings) -> DataFrame:
    columns = replace(X.POLLEN, keys=settings.keys)
    built = X.pollen_per_type(pollen_source(tables, settings), columns)
    levels = {f"{k}_observed": pollen_level(k, k) for k in POLLEN_LEVEL_LIMITS}
    names = _names(built, columns)
    data = matrix(built.withColumns(levels), names, "tree_observed")
    rows, how = with_stop(data, settings.levels)
    fits = at_once([
        lambda label=f"{kind}_observed": T.fit_boosted_levels(with_class_weight(rows, label, LEVELS, data.train), label, how)
        for kind in POLLEN_LEVEL_LIMITS
    ])
    scored = data.part("test")
    for kind, fitted in zip(POLLEN_LEVEL_LIMITS, fits):
        scored = fitted.with_level(scored, f"{kind}_forecast")
    return scored.select(
        *settings.keys, "date", *[c for k in POLLEN_LEVEL_LIMITS for c in (f"{k}_observed", f"{k}_forecast")]
    )


@model("pollen_two_stage", "Spike classifier mixing a quiet and a spike regressor")
def pollen_two_stage(tables: Tables, settings: Settings) -> DataFrame:
    columns = replace(X.POLLEN, keys=settings.keys)
    built = written(X.with_z_spike(X.pollen_two_stage(pollen_source(tables, settings), columns), columns))
    candidates = _names(built, columns, ["is_spike", "ratio_1d_7d"])
    names = varying_columns(built.filter(F.col("split") == "train"), candidates)
    data = matrix(built, names, "target_asinh", missing="median")
    rows, how = with_stop(data, settings.mixture)
    models = fit_two_stage(rows, how=how, classifier=replace(settings.spikes, stop_on=how.stop_on))
    return forecast_table(two_stage_predict(models, data.part("test")), settings, columns.target)
