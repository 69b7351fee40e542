"""Mergeable moments, and cross-validation built on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.functions.vectors import expand_pairs
from stargauge.operators import moments as M
from stargauge.operators import scale as SC
from stargauge.plans import crossval as CV
from stargauge.plans.recipes import LinearRecipe
from support import PROCESSED_SCHEMA, random_processed


def frame_of(spark, matrix, parts):
    rows = [(row.tolist(),) for row in matrix]
    return spark.createDataFrame(rows, "x array<double>").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_one_pass_equals_two_passes_far_from_zero(spark, parts):
    draw = np.random.default_rng(parts)
    matrix = np.column_stack([1e9 + draw.normal(0, 1e-1, 4000), draw.normal(size=4000), np.full(4000, 7.0)])
    state = M.array_state(frame_of(spark, matrix, parts), "x")
    assert state.n == 4000
    assert np.allclose(state.mean, matrix.mean(axis=0), rtol=1e-14)
    assert np.allclose(state.spread / 4000, matrix.var(axis=0), rtol=1e-6, atol=1e-20)


def test_tree_of_merges(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN_IN", 2)
    matrix = np.random.default_rng(1).normal(5, 2, (300, 4))
    state = M.array_state(frame_of(spark, matrix, 9), "x", M.co_deviations)
    assert np.allclose(state.spread / 300, np.cov(matrix.T, bias=True))


def test_products_are_measured_without_wide_rows(spark, monkeypatch):
    matrix = np.random.default_rng(2).normal(3, 1, (200, 12))
    wide = expand_pairs(matrix)
    monkeypatch.setattr(SC.V, "expand_pairs", None)
    moments = SC.array_moments(frame_of(spark, matrix, 3), "x", expand=True)
    assert np.allclose(moments.mean, wide.mean(axis=0)) and np.allclose(moments.scale, wide.std(axis=0))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "x array<double>")
    assert M.array_state(empty, "x") is None
    with pytest.raises(ValueError):
        SC.array_moments(empty, "x")


def test_two_hundred_genres_fit(spark):
    rows = [(i, i % 20, i % 30, float(i % 5 + 1), i * 3600, f"g{i % 200:03}|g{i * 7 % 200:03}") for i in range(600)]
    model = LinearRecipe().fit(spark.createDataFrame(rows, PROCESSED_SCHEMA))
    width = 200 + 9
    assert len(model.feature_columns) == width + width * (width - 1) // 2 == len(model.moments.mean)


def test_least_squares_is_the_shortest_solution():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(500, 3))
    x = np.column_stack([x, x[:, 0] + x[:, 1], np.ones(500)])
    y = x[:, :3] @ [1.0, -2.0, 0.5] + 4
    weights, intercept = M.least_squares(M.co_deviations(np.column_stack([x, y])))
    assert np.allclose(x @ weights + intercept, y)


def plain_cross_validation(frame, folds, features):
    """Statistics, weights and errors fold by fold, from pandas and numpy."""
    out = {}
    tokens = sorted({t for g in frame["genres"] for t in g.split("|")})
    time = frame["timestamp"].to_numpy()
    own = [[float(t in g.split("|")) for g in frame["genres"]] for t in tokens]
    own += [time // 3600 % 24, (time // 86400 + 3) % 7]
    for f in range(folds):
        rest = frame[frame["fold"] != f]
        mean, sides = rest["rating"].mean(), []
        for key in ("userId", "movieId"):
            stats = rest.groupby(key)["rating"].agg(["mean", "std", "count"])
            stats["std"] = stats["std"].fillna(0)
            found = stats.reindex(frame[key])
            sides.append(found.fillna({"mean": mean, "std": 0, "count": 1}).to_numpy())
        if features == "means":
            x = np.column_stack([sides[0][:, 0], sides[1][:, 0]])
        else:
            x = expand_pairs(np.column_stack([*sides, *own, sides[0][:, 0] * sides[1][:, 0]]))
        train = (frame["fold"] != f).to_numpy()
        scale = np.where(x[train].std(axis=0) > 1e-12, x[train].std(axis=0), 1)
        z = (x - x[train].mean(axis=0)) / scale
        y = frame["rating"].to_numpy()
        weights = np.linalg.lstsq(z[train], y[train] - y[train].mean(), rcond=1e-5)[0]
        error = (z @ weights + y[train].mean() - y)[~train]
        out[f] = float(np.sqrt((error**2).mean()))
    return out


@pytest.mark.parametrize("features", ["means", "recipe"])
def test_cross_validation_equals_refits(spark, features):
    rows, frame = random_processed(spark, rows=1500, users=25, items=30)
    frame["fold"] = [r["fold"] for r in CV.hash_folds(rows, 4).orderBy("row_id").collect()]
    got = {r["fold"]: r["rmse"] for r in CV.cross_validate_least_squares(rows, 4, features=features).collect()}
    want = plain_cross_validation(frame, 4, features)
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-6 for f in got)


def test_unseen_keys_and_missing_ratings(spark):
    rows = [(i, i, i % 3, float(i % 4), 0, "a") for i in range(40)] + [(99, 1, 1, None, 0, "a"), (98, None, 1, 3.0, None, None)]
    frame = spark.createDataFrame(rows, PROCESSED_SCHEMA)
    got = CV.cross_validate_least_squares(frame, 3, features="recipe").collect()
    assert sum(r["n"] for r in got) == 41 and all(np.isfinite(r["rmse"]) for r in got)
    assert CV.cross_validate_least_squares(frame.where(F.lit(False)), 3).collect() == []
    with pytest.raises(ValueError):
        CV.cross_validate_least_squares(frame, 3, features="other")
