"""Vocabularies kept as tables, and the sparse recipe built on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.operators import stats as ST
from stargauge.operators import vocabulary as VO
from stargauge.plans.estimators import create_model
from stargauge.plans.recipes import MlpRecipe, SparseRecipe, load_recipe
from support import PROCESSED_SCHEMA, random_processed


def test_places_follow_the_sorted_genres(spark):
    rows = [(1, "b|a"), (2, "c||b"), (3, None), (4, ""), (5, "a"), (6, "b|a")]
    frame = spark.createDataFrame(rows, "movieId long, genres string")
    vocabulary = VO.vocabulary_table(frame)
    assert sorted(tuple(r) for r in vocabulary.collect()) == [("a", 0, 3), ("b", 1, 3), ("c", 2, 1)]
    only = vocabulary.where("genre <> 'b'")
    placed = {r["movieId"]: r["places"] for r in VO.add_genre_places(frame, only).collect()}
    assert placed == {1: [0], 2: [2], 3: [], 4: [], 5: [0], 6: [0]}
    assert VO.vocabulary_table(frame.limit(0)).collect() == []


def test_sparse_features_equal_dense_ones(spark):
    rows, frame = random_processed(spark, rows=400)
    rows = rows.unionByName(rows.limit(1).withColumns({"genres": F.lit(None).cast("string"), "row_id": F.lit(9999)}))
    dense, sparse = MlpRecipe().fit(rows), SparseRecipe().fit(rows)
    assert sparse.width == len(dense.feature_columns) and sparse.vocabulary == []
    want = {r["row_id"]: r["features"] for r in dense.transform(rows).collect()}
    got = {r["row_id"]: r["features"].toArray() for r in sparse.transform(rows).collect()}
    names = dense.feature_columns
    order = [names.index(n) for n in sparse.feature_columns] + [i for i, n in enumerate(names) if n in dense.vocabulary]
    mean, scale = np.array(dense.moments.mean)[order], np.array(dense.moments.scale)[order]
    shift = np.where(np.arange(len(order)) < len(sparse.feature_columns), 0, mean / scale)
    for key, features in want.items():
        assert np.allclose(got[key] - shift, np.array(features)[order])


def test_six_thousand_genres_fit(spark, tmp_path, monkeypatch):
    def no_list(*_):
        raise AssertionError("a vocabulary list on the driver")

    monkeypatch.setattr(ST, "collect_vocabulary", no_list)
    rows = [(i, i % 40, i % 3000, float(i % 3000 % 2 + 3), i, f"g{2 * (i % 3000)}|g{2 * (i % 3000) + 1}") for i in range(6000)]
    frame = spark.createDataFrame(rows, PROCESSED_SCHEMA)
    recipe = SparseRecipe().fit(frame)
    assert recipe.state["genres"] == 6000
    recipe.save(str(tmp_path / "recipe"))
    features = load_recipe(spark, str(tmp_path / "recipe")).transform(frame)
    model = create_model("linear_regression").fit(features)
    error = model.transform(features).select(F.avg(F.abs(F.col("prediction") - F.col("rating")))).first()[0]
    assert error < 0.2


def test_columns_per_genre_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(ST, "MOST_COLUMNS", 3)
    frame = spark.createDataFrame([("a|b|c",), ("d",)], "genres string")
    with pytest.raises(ValueError, match="SparseRecipe"):
        ST.collect_vocabulary(frame)
    assert ST.collect_vocabulary(frame.limit(1)) == ["a", "b", "c"]
