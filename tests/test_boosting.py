"""Stop by patience, cut models, node tables, boosted levels, tuning."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.models import boosting as B
from tidemark.models import trees as T
from tidemark.models.prepare import matrix, predict_with
from tidemark.models.tuning import halving
from tidemark.operators.stats import with_class_weight

SMALL = T.Boosting(rounds=40, depth=3, step=0.3, rows=1.0, subset="all", stop_on="held", patience=5)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    y = np.where(x[:, 0] > 0, 2.0, -1.0) + rng.normal(size=400)
    pdf = pd.DataFrame({"id": np.arange(400), **dict(zip("abc", x.T)), "y": y, "hit": (y > 1).astype(float), "split": np.where(np.arange(400) % 4, "train", "val")})
    return T.with_validation_flag(matrix(spark.createDataFrame(pdf), list("abc"), "y").table, "held")


def test_best_round():
    assert B.best_round([3, 2, 1, 1, 1, 1], 3) == (3, True)
    assert B.best_round([3, 2, 1, 1.5, 0.5], 3) == (5, False)
    assert B.best_round([1, 2, 2, 0], 2) == (1, True)  # the later gain comes too late
    assert B.best_round([math.nan, 2, 3], 5) == (2, False)
    assert B.best_round([math.nan], 5) == (1, False)


def test_regressor_stops_at_its_best_round(rows):
    fit = T.staged_fit(rows, "y", SMALL)
    held, losses = rows.filter("held"), np.array(fit.losses)
    assert fit.kept < SMALL.rounds and fit.kept == losses[: fit.kept + 5].argmin() + 1
    assert (losses[fit.kept : fit.kept + 5] >= losses[fit.kept - 1]).all()
    scored = predict_with(fit.model, held).toPandas()
    assert np.sqrt(((scored["y"] - scored["predicted"]) ** 2).mean()) == pytest.approx(losses[fit.kept - 1])
    curve = fit.curve(rows).toPandas()
    assert curve["kept"].sum() == fit.kept and list(curve["round"]) == list(range(1, len(losses) + 1))


def test_cut_is_the_same_as_fewer_rounds(rows):
    train = rows.filter("not held")
    full = T.fit_boosted(train, "y", T.Boosting(rounds=12, depth=3, step=0.3, rows=1.0, subset="all"))
    few = T.fit_boosted(train, "y", T.Boosting(rounds=4, depth=3, step=0.3, rows=1.0, subset="all"))
    both = predict_with(few, predict_with(B.cut(full, 4), rows, "cut"), "few").toPandas()
    np.testing.assert_allclose(both["cut"], both["few"])
    assert B.cut(full, 99) is full


def test_no_validation_rows_is_an_error(rows):
    with pytest.raises(ValueError, match="nothing to stop on"):
        T.staged_fit(rows.filter("not held"), "y", SMALL)


def test_area_after_each_round(rows):
    held = rows.filter("held")
    fit = T.staged_fit(rows, "hit", SMALL, loss="auc")
    model = fit.model
    said = T.with_probability(model, held, "p").toPandas()
    gap = said[said.hit == 1]["p"].to_numpy()[:, None] - said[said.hit == 0]["p"].to_numpy()[None]
    want = (gap > 0).mean() + 0.5 * (gap == 0).mean()
    areas = B.staged_auc(model, held, "hit", bins=100_000)
    assert len(areas) == fit.kept and areas[-1] == pytest.approx(want, abs=1e-4)
    assert 1 - min(fit.losses) == pytest.approx(B.staged_auc(model, held, "hit")[-1])
    assert all(math.isnan(a) for a in B.staged_auc(model, held.filter("hit = 1"), "hit"))
    assert T.fit_spike_classifier(rows, "hit", SMALL).getNumTrees == fit.kept


def test_split_counts_equal_the_saved_nodes(spark, rows):
    model = T.fit_boosted(rows.filter("not held"), "y", T.Boosting(rounds=6, depth=3, rows=1.0, subset="all"))
    want = {n: model.toDebugString.count(f"If (feature {i} ") for i, n in enumerate("abc")}
    got = B.split_counts(model, list("abc"), spark)
    assert {r["feature"]: r["splits"] for r in got.collect()} == want
    assert [r["splits"] for r in got.collect()] == sorted(want.values(), reverse=True)
    assert B.split_counts(model, list("abcd"), spark).filter("feature = 'd'").first()["splits"] == 0


def test_refit_takes_the_validation_rows_in(rows):
    assert T.refit_boosted(rows, "y", SMALL).getNumTrees == T.staged_fit(rows, "y", SMALL).kept


@pytest.fixture(scope="module")
def levels(spark):
    """Three levels, the last one rare and hard to tell from the first; level 3 occurs in no train row."""
    rng = np.random.default_rng(9)
    n = 1500
    level = rng.choice([0, 1, 2], n, p=[0.6, 0.35, 0.05])
    a = np.where(level == 1, 2.0, 0.0) + rng.normal(size=n) * 0.7
    b = np.where(level == 2, 1.0, 0.0) + rng.normal(size=n) * 0.7
    split = np.where(np.arange(n) % 3 == 0, "val", np.where(np.arange(n) % 3 == 1, "train", "test"))
    level = np.where((split == "test") & (np.arange(n) % 200 == 2), 3, level)
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "level": level, "split": split})
    return T.with_validation_flag(matrix(spark.createDataFrame(pdf), ["a", "b"], "level").table, "held")


def test_boosted_levels_and_their_weights(levels):
    weighted = with_class_weight(levels, "level", [0, 1, 2, 3], levels.filter("split = 'train'")).fillna(1.0, ["weight"])
    fit_on = weighted.filter("split <> 'test'")
    test = levels.filter("split = 'test'")
    recall = {}
    for weight in ("weight", None):
        fitted = T.fit_boosted_levels(fit_on, "level", SMALL, weight)
        assert fitted.levels == (0, 1, 2) and all(s.kept < SMALL.rounds for s in fitted.staged)
        got = fitted.with_level(test, "said", "p").toPandas()
        p = np.array(got["p"].tolist())
        np.testing.assert_allclose(p.sum(1), 1)
        assert (got["said"] == p.argmax(1)).all() and len(got) == 500
        recall[weight] = (got[got.level == 2]["said"] == 2).mean()
        assert (got[got.level == 1]["said"] == 1).mean() > 0.7
    assert recall["weight"] > recall[None] + 0.1


def test_one_level_only(levels):
    same = levels.withColumn("level", F.lit(4))
    fitted = T.fit_boosted_levels(same, "level", SMALL, None)
    assert {r["said"] for r in fitted.with_level(same, "said").select("said").distinct().collect()} == {4}
    with pytest.raises(ValueError):
        T.fit_boosted_levels(same.withColumn("level", F.lit(None).cast("int")), "level", SMALL, None)


def test_halving_finds_the_exhaustive_best(rows):
    train, held = rows.filter("not held"), rows.filter("held")
    grid = [(d, m) for d in (1, 2, 4) for m in (1, 40)]

    def loss(setting, trees):
        model = T.fit_forest(train, "y", T.Forest(trees=trees, depth=setting[0], min_leaf=setting[1], subset="all"))
        table = predict_with(model, held).toPandas()
        return float(np.sqrt(((table["y"] - table["predicted"]) ** 2).mean()))

    trials = halving(grid, loss, (4, 12), keep=0.5)
    assert len(trials) == 6 + 3 and [t.budget for t in trials] == [12] * 3 + [4] * 6
    whole = min(grid, key=lambda s: loss(s, 12))
    assert trials[0].setting == whole
    assert halving([1, 2], lambda s, b: math.nan if s == 1 else 5.0, (1,))[0].setting == 2
