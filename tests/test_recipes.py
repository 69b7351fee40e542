import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from support import PROCESSED_SCHEMA, random_processed
from stargauge.plans.recipes import RECIPE_BY_MODEL, BoostingRecipe, ForestRecipe, LinearRecipe, MlpRecipe, load_recipe
from stargauge.plans.recipes.forest import attach_latent_factors, latent_factors
from stargauge.plans.training import build_features
from stargauge.session import materialize

GENRES = ["Action", "Adventure", "Comedy", "Drama"]
MEAN_COLUMNS = [
    "user_avg_rating", "user_std_rating", "user_rating_count",
    "movie_avg_rating", "movie_std_rating", "movie_rating_count",
]


def matrix(df):
    rows = df.orderBy("row_id").collect()
    return np.array([r["features"] for r in rows])


def table(model, df):
    return pd.DataFrame(matrix(model.transform(df)), columns=model.feature_columns)


@pytest.fixture(scope="module")
def rest(random_rows):
    return materialize(random_rows[0], "test-rows")


@pytest.fixture(scope="module")
def fitted(rest):
    """One fitted recipe per model, shared by the tests below."""
    options = {"random_forest": {"n_svd_components": 4, "n_iter": 2}}
    return {name: recipe(**options.get(name, {})).fit(rest) for name, recipe in RECIPE_BY_MODEL.items()}


def test_mlp_columns_and_scaling(fitted, rest):
    model = fitted["multi_layer_perceptron"]
    assert model.feature_columns == MEAN_COLUMNS + GENRES + ["Sci-Fi", "rating_hour", "rating_dayofweek", "user_movie_avg_interaction"]
    x = table(model, rest)
    assert np.allclose(x.mean(), 0, atol=1e-9)
    assert np.allclose(x.std(ddof=0), 1, atol=1e-9)


def test_mlp_against_pandas(fitted, rest, random_rows):
    pdf = random_rows[1]
    users = pdf.groupby("userId")["rating"].agg(["mean", "std", "count"]).fillna(0)
    movies = pdf.groupby("movieId")["rating"].agg(["mean", "std", "count"]).fillna(0)
    wide = np.column_stack([users.loc[pdf["userId"]], movies.loc[pdf["movieId"]]])
    hot = pdf["genres"].str.get_dummies(sep="|")
    when = pd.to_datetime(pdf["timestamp"], unit="s")
    product = wide[:, 0] * wide[:, 3]
    x = np.column_stack([wide, hot, when.dt.hour, when.dt.dayofweek, product])
    got = matrix(fitted["multi_layer_perceptron"].transform(rest))
    assert np.allclose(got, (x - x.mean(axis=0)) / x.std(axis=0), atol=1e-8)


@pytest.mark.parametrize("name", list(RECIPE_BY_MODEL))
def test_cold_rows_are_finite_and_order_does_not_matter(spark, fitted, name):
    cold = spark.createDataFrame(
        [(0, 999, 1, 4.0, 978307200, "Action"), (1, 1, 999, 3.0, 978307300, "Western|New"), (2, 999, 999, 3.0, 978307400, None)],
        PROCESSED_SCHEMA,
    )
    x = matrix(fitted[name].transform(cold))
    assert x.shape == (3, len(fitted[name].feature_columns)) and np.isfinite(x).all()
    assert np.array_equal(x, matrix(fitted[name].transform(cold.repartition(3))))


@pytest.mark.parametrize("name", list(RECIPE_BY_MODEL))
def test_stored_recipe_gives_the_same_features(spark, fitted, rest, name, tmp_path):
    fitted[name].save(str(tmp_path / name))
    again = load_recipe(spark, str(tmp_path / name))
    assert again.feature_columns == fitted[name].feature_columns
    assert np.allclose(matrix(again.transform(rest)), matrix(fitted[name].transform(rest)))


def test_missing_recipe(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_recipe(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("recipe", list(RECIPE_BY_MODEL.values()))
def test_missing_column_raises(processed, recipe):
    with pytest.raises(KeyError):
        recipe().fit(processed.drop("genres"))


def test_mlp_cold_user_gets_global_mean(spark, processed):
    model = MlpRecipe().fit(processed)
    cold = spark.createDataFrame([(0, 999, 999, 4.0, 964982703, "Action")], PROCESSED_SCHEMA)
    x = matrix(model.transform(cold))[0] * np.array(model.moments.scale) + np.array(model.moments.mean)
    named = dict(zip(model.feature_columns, x))
    assert named["user_avg_rating"] == pytest.approx(3.75) and named["movie_rating_count"] == pytest.approx(1)
    assert named["user_movie_avg_interaction"] == pytest.approx(3.75**2)


def test_linear_width_order_and_scale(fitted, rest):
    model = fitted["linear_regression"]
    base = len(MEAN_COLUMNS) + 5 + 3
    x = table(model, rest)
    assert x.shape[1] == base + base * (base - 1) // 2
    std = x.std(ddof=0)
    assert np.allclose(x.mean(), 0, atol=1e-9) and set(np.round(std, 6)) <= {0.0, 1.0}
    assert std["Comedy Sci-Fi"] == 0 and std["user_avg_rating movie_avg_rating"] == pytest.approx(1)


def test_linear_can_recompute_statistics(spark, rest):
    model = LinearRecipe(stats_scope="input").fit(rest)
    part = rest.filter("userId <= 3")
    fixed = LinearRecipe().fit(rest)
    assert not np.allclose(matrix(model.transform(part)), matrix(fixed.transform(part)))
    assert np.allclose(matrix(model.transform(rest)), matrix(fixed.transform(rest)))
    with pytest.raises(ValueError):
        LinearRecipe(stats_scope="other")


def test_forest_columns_and_values(processed):
    model = ForestRecipe(n_svd_components=2).fit(processed)
    assert model.feature_columns == [
        "user_avg_rating", "user_rating_count", "user_rating_std",
        "movie_avg_rating", "movie_rating_count", "movie_rating_std",
        "user_factor_0", "movie_factor_0", "user_factor_1", "movie_factor_1",
        *GENRES, "num_genres", "user_rating_deviation", "movie_rating_deviation",
    ]
    x = table(model, processed)
    assert x.loc[0, "user_rating_deviation"] == -0.5 and x.loc[0, "movie_rating_deviation"] == 0.5
    assert list(x["num_genres"][:3]) == [2, 2, 1]
    assert list(x.loc[0, GENRES]) == [1, 1, 0, 0] and list(x.loc[1, GENRES]) == [0, 0, 1, 1]


def test_forest_unseen_user_is_zero(spark, processed):
    model = ForestRecipe(n_svd_components=2).fit(processed)
    cold = spark.createDataFrame([(0, 999, 1, 4.0, 964982703, "Action")], PROCESSED_SCHEMA)
    x = table(model, cold).loc[0]
    assert x["user_avg_rating"] == 0 and x["user_factor_0"] == 0 and x["user_rating_deviation"] == 0
    vectors = attach_latent_factors(cold, model).first()
    assert vectors["user_factors"] == [0.0, 0.0] and vectors["movie_factors"] != [0.0, 0.0]
    assert latent_factors(model, "userId").count() == 3


def test_forest_without_target(processed):
    model = ForestRecipe(n_svd_components=2, include_target_deviation=False).fit(processed)
    assert model.feature_columns[-1] == "num_genres"
    assert matrix(model.transform(processed)).shape[1] == len(model.feature_columns)


def test_boosting_values(processed):
    model = BoostingRecipe().fit(processed)
    x = table(model, processed)
    assert list(x.columns[:6]) == ["rating_month", "rating_day", "rating_hour", "rating_dayofweek", "rating_quarter", "rating_year"]
    assert [c for c in x if c.startswith("user_dow_")] == [f"user_dow_{i}_avg" for i in range(7)]
    assert [c for c in x if c.startswith("user_month_")] == [f"user_month_{i}_avg" for i in range(1, 13)]
    assert list(x["user_avg_rating"]) == [4.5, 4.5, 3.75, 3.75, 3.0, 3.0]
    assert list(x["movie_popularity"]) == [2, 2, 2, 1, 2, 1] and set(x["user_activity"]) == {2}
    assert list(x["user_rating_rolling_5"]) == [4.0, 4.5, 3.0, 3.75, 2.5, 3.0]
    assert x.loc[0, "user_Action_preference"] == pytest.approx(4 / (1 + 1e-6))


def test_boosting_keeps_features_with_their_row(spark, processed):
    """Features and rating stay together although the window sorts by user and time."""
    model = BoostingRecipe().fit(processed)
    rows = model.transform(processed.orderBy("timestamp", ascending=False)).collect()
    at = model.feature_columns.index("user_activity")
    assert {r["row_id"]: r["rating"] for r in rows} == {r["row_id"]: r["rating"] for r in processed.collect()}
    assert all(r["features"][at] == 2 for r in rows)


def test_boosting_single_rating_users_and_movie_age(spark):
    rows = [(i, i + 1, i + 1, r, 964982703 + i, "A", 1990 + i) for i, r in enumerate([4.0, 3.0, 5.0])]
    df = spark.createDataFrame(rows, PROCESSED_SCHEMA + ", movie_year int")
    model = BoostingRecipe(exclude_current=True).fit(df)
    x = table(model, df)
    assert set(x["user_rating_std"]) == {0} and list(x["movie_age"]) == [34, 33, 32]
    assert set(x["user_rating_rolling_5"]) == {0}


def test_fit_scope(rest):
    train_fit, train, test = build_features(rest, "multi_layer_perceptron")
    all_fit, _, _ = build_features(rest, "multi_layer_perceptron", fit_scope="all")
    assert train.count() + test.count() == 300
    assert train_fit.moments.count == train.count() and all_fit.moments.count == 300
    with pytest.raises(ValueError):
        build_features(rest, "multi_layer_perceptron", fit_scope="test")


def test_whole_scope_prepares_before_it_splits(rest):
    fitted, train, test = build_features(rest, "gradient_boosting", fit_scope="all")
    sides = {r["row_id"]: r["features"] for r in train.unionByName(test).collect()}
    whole = {r["row_id"]: r["features"] for r in fitted.transform(rest).collect()}
    assert sides.keys() == whole.keys() and all(np.allclose(sides[i], whole[i]) for i in whole)


@pytest.mark.parametrize("recipe", [LinearRecipe, MlpRecipe, BoostingRecipe])
def test_one_missing_time_spoils_one_row_at_most(spark, rest, recipe):
    first = rest.agg({"row_id": "min"}).first()[0]
    holed = materialize(rest.withColumn("timestamp", F.when(F.col("row_id") != first, F.col("timestamp"))), "holed")
    rows = recipe().fit(holed).transform(holed).collect()
    assert all(np.isfinite(r["features"]).all() for r in rows if r["row_id"] != first)


def test_an_empty_vocabulary_is_kept(rest):
    assert LinearRecipe(vocabulary=[]).fit(rest).vocabulary == []
    assert MlpRecipe(vocabulary=[]).fit(rest).vocabulary == []


def test_thousand_rows_in_five_seconds(spark):
    df, _ = random_processed(spark, rows=1000, users=50, items=3)
    df = materialize(df, "thousand")
    MlpRecipe().fit(df).transform(df).count()
    started = time.time()
    model = MlpRecipe().fit(df)
    assert len(matrix(model.transform(df))) == 1000
    assert time.time() - started < 5


def test_window_and_user_join_share_one_exchange(spark, fitted, rest):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = fitted["gradient_boosting"].transform(rest)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Each rolling mean shares one window; the user arrays move once, to the join.
    assert plan.count("Exchange hashpartitioning") <= 6
    assert "Python" not in plan
