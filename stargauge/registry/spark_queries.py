"""Every registered query: (spark, data folder) -> DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import genres as G
from ..functions import scores as S
from ..functions.vectors import array_score
from ..operators import encode as EN
from ..operators import metrics as ME
from ..operators import quantiles as QU
from ..operators import scale as SC
from ..operators import segments as SG
from ..operators import stats as ST
from ..operators import vocabulary as VO
from ..operators.attach import (
    attach,
    attach_zero,
    cold_start_defaults,
    fill_defaults,
)
from ..operators.factors import singular_value_table, svd_factors
from ..operators.preprocess import drop_sentinel, filter_counts, preprocess, table_profile
from ..operators.provenance import kept_rows, provenance_join
from ..operators.rolling import rolling_means
from ..operators.split import hash_split, train_test
from ..plans import training
from ..plans.crossval import cross_validate_least_squares
from ..plans.estimators import create_model, load_model, save_model
from ..plans.mlp import VALIDATION_SEED_SHIFT, MlpRegressor
from ..plans.recipes import BoostingRecipe, ForestRecipe, LinearRecipe, MeansRecipe, MlpRecipe, SparseRecipe, load_recipe
from ..plans.recipes.forest import attach_latent_factors
from ..plans.scoring import prediction_output, score
from ..session import at_rest, materialize, new_scratch_path
from ..sources import views
from ..sources.readers import CSV_READING, read_movies_csv, read_ratings_csv, read_ratings_with_row_id, read_table
from ..sources.writers import read_feature_table, write_feature_table, write_metrics, write_predictions, write_table
from . import baselines as B
from .formula import FORMULA_WIDTHS, formula_network

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RATING_COLUMNS = ["userId", "movieId", "rating", "timestamp"]
ALIGNED_VOCABULARY = ["blue", "cold", "old", "vintage"]
ENGAGEMENT = {"low": 60, "medium": 70}
TARGETS = {"rmse": ("<", 0.70), "mae": ("<", 0.50), "r2": (">", 0.40)}


def query(function: Query | str):
    """Register a function under its own name, or under a given one."""
    if isinstance(function, str):
        return lambda f: QUERIES.setdefault(function, f)
    return QUERIES.setdefault(function.__name__, function)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and whole numbers widened to long, so both engines print the same."""
    columns: list[Column] = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "double":
            column = F.round(column, digits)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("long")
        columns.append(column.alias(name))
    return df.select(*columns)


def flat_features(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Keys plus one column per feature."""
    cells = [F.col("features")[i].alias(n) for i, n in enumerate(names)]
    return rounded(df.select(*keys, *cells))


def checksum(df: DataFrame, keys: list[str]) -> DataFrame:
    """Position-weighted sum and sum of squares of the feature array."""
    weighted = array_score(lambda x: x @ np.arange(1.0, x.shape[1] + 1))("features")
    squares = array_score(lambda x: (x * x).sum(axis=1))("features")
    return df.select(
        *keys,
        F.size("features").cast("long").alias("n_features"),
        F.round(weighted, 4).alias("weighted_sum"),
        F.round(squares, 4).alias("square_sum"),
    )


def genre_columns(names: list[str], vocabulary: list[str]) -> list[str]:
    return [f"genre_{n}" if n in vocabulary else n for n in names]


# --- scans and sinks -----------------------------------------------------------------------------


@query
def scan_ratings(spark, folder):
    path = new_scratch_path(spark, "ratings-csv")
    write_table(views.ratings_e(spark, folder).select(*RATING_COLUMNS), path, "csv")
    return read_ratings_csv(spark, path)


@query
def scan_movies(spark, folder):
    """Some titles hold quotes and commas, some are empty, some are missing."""
    path = new_scratch_path(spark, "movies-csv")
    quoted = F.concat(F.lit('Say "'), F.col("title"), F.lit('", twice'))
    title = (
        F.when(F.col("movieId") % 5 == 0, quoted).when(F.col("movieId") % 7 == 0, "")
        .when(F.col("movieId") % 11 != 0, F.col("title"))
    )
    write_table(views.movies(spark, folder).withColumn("title", title), path, "csv")
    return read_movies_csv(spark, path)


@query
def feature_table(spark, folder):
    processed = at_rest(views.prep_e(spark, folder), "prep")
    model = MlpRecipe().fit(processed)
    path = new_scratch_path(spark, "feature-table")
    write_feature_table(model.transform(processed), model.feature_columns, path)
    table, names = read_feature_table(spark, path)
    return flat_features(table, ["row_id", "rating"], genre_columns(names, model.vocabulary))


@query
def profile(spark, folder):
    left = preprocess(views.ratings_e(spark, folder), views.movies(spark, folder), "left")
    return table_profile(left)


# --- filters, projections, joins -----------------------------------------------------------------


@query
def filter_sentinel(spark, folder):
    return drop_sentinel(views.movies(spark, folder))


@query
def align_unseen(spark, folder):
    return rounded(EN.multi_hot_columns(views.prep_l(spark, folder), ALIGNED_VOCABULARY))


@query
def cold_start_fill(spark, folder):
    """Statistics of the event ratings looked up by the much wider order ratings."""
    fitted = views.prep_e(spark, folder)
    mean = ST.global_mean(fitted).first()["global_mean"]
    joined = attach(views.prep_l(spark, folder), ST.user_stats(fitted), "userId")
    joined = attach(joined, ST.movie_stats(fitted), "movieId")
    defaults = cold_start_defaults(mean, "user") | cold_start_defaults(mean, "movie")
    return rounded(fill_defaults(joined, defaults))


@query
def preprocess_join(spark, folder):
    return views.prep_l(spark, folder)


@query
def preprocess_left(spark, folder):
    return preprocess(views.ratings_e(spark, folder), views.movies(spark, folder), "left")


@query
def attach_user_stats(spark, folder):
    rows = views.prep_l(spark, folder)
    return rounded(attach(rows, ST.user_stats(rows), "userId"))


@query
def attach_movie_stats(spark, folder):
    rows = views.prep_l(spark, folder)
    return rounded(attach(rows, ST.movie_stats(rows), "movieId"))


@query
def attach_user_profile(spark, folder):
    rows = views.prep_e(spark, folder)
    return rounded(attach(rows, ST.user_profile(rows), "userId"))


@query
def attach_lookups(spark, folder):
    """Fitted on event ratings, looked up by order ratings: unknown keys become 0."""
    fitted = views.prep_e(spark, folder)
    vocabulary = ST.collect_vocabulary(fitted)
    preferences = [
        e.alias(f"user_{g}_preference")
        for g, e in zip(vocabulary, ST.genre_preferences(vocabulary))
    ]
    users = fitted.groupBy("userId").agg(
        F.count(F.lit(1)).alias("user_activity"),
        F.avg("rating").alias("user_avg_rating"),
        ST.sample_std().alias("user_rating_std"),
        *preferences,
    )
    movies = fitted.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("movie_popularity"),
        F.avg("rating").alias("movie_avg_rating"),
        ST.sample_std().alias("movie_rating_std"),
    )
    joined = attach_zero(views.prep_l(spark, folder), users, "userId")
    return rounded(attach_zero(joined, movies, "movieId"))


@query
def attach_factors(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = ForestRecipe(n_svd_components=10).fit(rows)
    return attach_latent_factors(rows, model).select("row_id", "user_factors", "movie_factors")


@query("provenance_join")
def provenance(spark, folder):
    processed = views.prep_e(spark, folder).drop("row_id")
    return provenance_join(processed, views.ratings_e(spark, folder))


@query
def hash_split_eighth(spark, folder):
    """A share that is no whole per cent."""
    return hash_split(views.ratings_e(spark, folder), 0.125).select("row_id", "split")


@query("provenance_fan_out")
def provenance_fan_out(spark, folder):
    """Every third rating also in a copy, so that keys meet more than once."""
    processed = views.prep_e(spark, folder).drop("row_id")
    ratings = views.ratings_e(spark, folder)
    copies = ratings.filter("row_id % 3 = 0").withColumn("row_id", -F.col("row_id") - 1)
    return provenance_join(processed, ratings.unionByName(copies), fan_out=True)


@query("kept_rows")
def kept_rows_query(spark, folder):
    return kept_rows(views.ratings_e(spark, folder), views.movies(spark, folder))


# --- aggregations --------------------------------------------------------------------------------


@query
def user_stats(spark, folder):
    return rounded(ST.user_stats(views.prep_l(spark, folder)))


@query
def movie_stats(spark, folder):
    return rounded(ST.movie_stats(views.prep_l(spark, folder), "movie_rating_std"))


@query
def global_mean(spark, folder):
    return rounded(ST.global_mean(views.prep_l(spark, folder)))


@query
def popularity_activity(spark, folder):
    """Both size tables in one frame."""
    rows = views.prep_l(spark, folder)
    sizes = [
        ST.group_sizes(rows, key, "n").select(F.lit(name).alias("kind"), F.col(key).alias("key"), "n")
        for key, name in (("movieId", "movie_popularity"), ("userId", "user_activity"))
    ]
    return sizes[0].unionByName(sizes[1])


@query
def user_dow_profile(spark, folder):
    return rounded(ST.user_dow_profile(views.prep_l(spark, folder)))


@query
def user_month_profile(spark, folder):
    return rounded(ST.user_month_profile(views.prep_l(spark, folder)))


@query
def user_genre_pref(spark, folder):
    rows = views.prep_l(spark, folder)
    vocabulary = ST.collect_vocabulary(views.movies(spark, folder).filter(G.is_not_sentinel()))
    return rounded(ST.user_genre_preference(rows, vocabulary))


@query
def user_genre_pref_token(spark, folder):
    rows = views.prep_l(spark, folder)
    vocabulary = ST.collect_vocabulary(views.movies(spark, folder).filter(G.is_not_sentinel()))
    return rounded(ST.user_genre_preference(rows, vocabulary, "token"))


@query
def user_genre_pref_long(spark, folder):
    return rounded(ST.user_genre_preference_long(views.prep_l(spark, folder)))


@query
def user_item_mean(spark, folder):
    return rounded(ST.user_item_mean(views.prep_l(spark, folder)))


@query
def genre_vocab(spark, folder):
    return ST.genre_vocabulary(views.prep_l(spark, folder))


@query("filter_counts")
def filter_count(spark, folder):
    return filter_counts(views.ratings_l(spark, folder), views.movies(spark, folder))


# --- windows -------------------------------------------------------------------------------------


@query
def rolling_mean_5(spark, folder):
    rows = rolling_means(views.prep_e(spark, folder), (5,))
    return rounded(rows.select("row_id", "userId", "user_rating_rolling_5"))


@query
def rolling_mean_10(spark, folder):
    rows = rolling_means(views.prep_e(spark, folder), (5, 10))
    return rounded(rows.select("row_id", "userId", "user_rating_rolling_5", "user_rating_rolling_10"))


@query
def rolling_mean_previous(spark, folder):
    """Without the current row: null for a user's first rating."""
    rows = rolling_means(views.prep_e(spark, folder), (5, 10), exclude_current=True)
    return rounded(rows.select("row_id", "userId", "user_rating_rolling_5", "user_rating_rolling_10"))


@query
def group_transform(spark, folder):
    rows = views.prep_l(spark, folder)
    rows = ST.group_transform(rows, "userId", "user_avg_rating", "user_rating_std")
    return rounded(ST.group_transform(rows, "movieId", "movie_avg_rating", "movie_rating_std"))


# --- scalar functions ----------------------------------------------------------------------------


@query
def time_features(spark, folder):
    rows = EN.add_time_features(views.ratings_e(spark, folder))
    return rounded(rows.drop("userId", "movieId", "rating"))


@query
def genre_multi_hot(spark, folder):
    rows = views.prep_e(spark, folder)
    vocabulary = ST.collect_vocabulary(rows)
    return rounded(EN.multi_hot_columns(rows.select("row_id", "genres"), vocabulary).drop("genres"))


@query
def num_genres(spark, folder):
    return rounded(EN.add_num_genres(views.prep_e(spark, folder).select("row_id", "genres")))


@query
def movie_year_age(spark, folder):
    ratings = views.ratings_e(spark, folder).select("row_id", "movieId")
    rows = preprocess(ratings, views.movies(spark, folder), "left", with_year=True)
    return rounded(rows.drop("genres"))


def _with_stats(spark, folder):
    rows = views.prep_e(spark, folder)
    users = ST.user_stats(rows).select("userId", "user_avg_rating")
    movies = ST.movie_stats(rows).select("movieId", "movie_avg_rating")
    return attach(attach(rows, users, "userId"), movies, "movieId")


@query
def mean_interaction(spark, folder):
    rows = EN.add_mean_interaction(_with_stats(spark, folder))
    return rounded(rows.select("row_id", "user_movie_avg_interaction"))


@query
def rating_deviation(spark, folder):
    rows = EN.add_rating_deviations(_with_stats(spark, folder))
    return rounded(rows.select("row_id", "user_rating_deviation", "movie_rating_deviation"))


@query
def clip_predictions(spark, folder):
    """Stretched predictions leave the rating range, so that clipping has an effect; some are missing."""
    rows = B.blend_predictions(spark, folder)
    raw = F.when(F.col("row_id") % 10 != 0, F.col("prediction") * 3 - 5)
    stretched = rows.withColumn("raw", F.when(F.col("row_id") % 10 == 5, float("nan")).otherwise(raw))
    clipped = stretched.withColumn("clipped", S.clip("raw"))
    error = S.absolute_error("clipped", "rating")
    return rounded(clipped.select("row_id", "raw", "clipped", error.alias("error")))


# --- transforms ----------------------------------------------------------------------------------


@query
def standard_scale(spark, folder):
    names = ["userId", "movieId", "rating", "timestamp"]
    rows = EN.features_array(views.prep_e(spark, folder), names)
    moments = SC.array_moments(rows, "features")
    scaled = SC.scale_array(rows, "features", moments)
    return flat_features(scaled, ["row_id"], [f"{n}_scaled" for n in names])


@query
def pairwise_interactions(spark, folder):
    rows = EN.add_num_genres(EN.add_time_features(views.prep_e(spark, folder)))
    names = ["rating", "rating_hour", "rating_dayofweek", "num_genres"]
    pairs = SC.pairwise_interactions(EN.features_array(rows, names), "features")
    return flat_features(pairs, ["row_id"], [f"x{i}" for i in range(10)])


@query("svd_factors")
def svd_values(spark, folder):
    return rounded(singular_value_table(svd_factors(views.prep_e(spark, folder), 20)), 3)


def _low_rank(spark, folder):
    """Ratings whose user x movie matrix has twelve columns and rank four: means by class, each in three sizes."""
    means = (
        views.prep_e(spark, folder)
        .groupBy("userId", (F.col("movieId") % 4).alias("kind"))
        .agg(F.avg("rating").alias("mean"))
    )
    turn = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("turn")
    column = F.col("kind") + 4 * F.col("turn")
    cells = means.select("userId", "kind", "mean", turn).select(
        "userId", column.alias("movieId"), (F.col("mean") * (F.col("turn") + 0.7310585)).alias("rating")
    )
    return at_rest(cells, "low-rank")


@query
def svd_energy(spark, folder):
    """All components together carry the whole squared length of the matrix."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    width = rows.select("movieId").distinct().count()
    values = singular_value_table(svd_factors(rows, width, n_iter=1))
    energy = F.sum(F.col("singular_value") * F.col("singular_value"))
    return values.agg(F.round(energy, 3).alias("energy"))


@query
def svd_reconstruction(spark, folder):
    """User x movie factors with all components give back every rated cell."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    width = rows.select("movieId").distinct().count()
    factors = svd_factors(rows, width, n_iter=1)
    users = factors.user_factors.withColumnRenamed("factors", "u")
    movies = factors.movie_factors.withColumnRenamed("factors", "v")
    joined = attach(attach(ST.user_item_mean(rows), users, "userId"), movies, "movieId")
    products = array_score(lambda x: (x[:, :width] * x[:, width:]).sum(axis=1))(F.concat("u", "v"))
    return rounded(joined.select("userId", "movieId", products.alias("rating")), 4)


@query
def factor_products(spark, folder):
    """The forest recipe's factor columns, multiplied per row, on a matrix of rank four."""
    rows = _low_rank(spark, folder).withColumns(
        {"row_id": F.col("userId") * 12 + F.col("movieId"), "timestamp": F.lit(0), "genres": F.lit("a")}
    )
    model = ForestRecipe(n_svd_components=4, vocabulary=["a"]).fit(rows)
    at = {name: i for i, name in enumerate(model.feature_columns)}
    pairs = [F.col("features")[at[f"user_factor_{i}"]] * F.col("features")[at[f"movie_factor_{i}"]] for i in range(4)]
    product = sum(pairs[1:], pairs[0])
    return rounded(model.transform(rows).select("userId", "movieId", "rating", product.alias("product")), 4)


# --- recipes -------------------------------------------------------------------------------------


@query
def recipe_mlp(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = MlpRecipe().fit(rows)
    names = genre_columns(model.feature_columns, model.vocabulary)
    return flat_features(model.transform(rows), ["row_id", "rating"], names)


@query
def vocabulary_table(spark, folder):
    """Every genre's place and rows, without a list on the driver."""
    return VO.vocabulary_table(views.prep_l(spark, folder))


@query
def genre_places(spark, folder):
    """Each row's genres as places in the vocabulary of the cheaper half; other genres drop out."""
    rows = views.prep_e(spark, folder)
    vocabulary = VO.vocabulary_table(rows.filter("movieId % 2 = 0"))
    placed = VO.add_genre_places(rows, vocabulary)
    return placed.select("row_id", F.concat_ws(",", F.col("places").cast("array<string>")).alias("places"))


@query
def recipe_sparse(spark, folder):
    """Sparse features per row: entries, their weighted sum and squared length."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = SparseRecipe().fit(rows)
    entries = model.prepare(rows).select("row_id", "features.*")
    terms = F.zip_with("indices", "values", lambda i, v: (i + 1) * v)
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda a, v: a + v)
    return rounded(
        entries.select(
            "row_id", F.col("size").alias("width"), F.size("indices").alias("entries"),
            total(terms).alias("weighted_sum"), total(F.transform("values", lambda v: v * v)).alias("square_sum"),
        ),
        4,
    )


@query
def recipe_linear(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    return checksum(LinearRecipe().fit(rows).transform(rows), ["row_id", "rating"])


@query
def recipe_forest(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = ForestRecipe(n_svd_components=20).fit(rows)
    return flat_features(model.transform(rows), ["row_id", "rating"], model.feature_columns)


@query
def recipe_forest_stats(spark, folder):
    """The forest recipe without the factor columns, whose values SQL cannot give."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = ForestRecipe(n_svd_components=5).fit(rows)
    names = genre_columns(model.feature_columns, model.vocabulary)
    flat = flat_features(model.transform(rows), ["row_id", "rating"], names)
    return flat.select(*[c for c in flat.columns if "_factor_" not in c])


@query
def recipe_boosting(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    model = BoostingRecipe().fit(rows)
    names = genre_columns(model.feature_columns, model.vocabulary)
    return flat_features(model.transform(rows), ["row_id", "rating"], names)


# --- splits and models ---------------------------------------------------------------------------


@query("hash_split")
def split_rows(spark, folder):
    return hash_split(views.ratings_e(spark, folder)).select("row_id", "split")


def _metrics_of(result: dict, spark: SparkSession) -> DataFrame:
    rows = [
        (side, *[float(m[k]) for k in ME.METRICS], int(m["n"]))
        for side, m in sorted(result["metrics"].items())
    ]
    kinds = ", ".join(f"{k} double" for k in ME.METRICS)
    return rounded(spark.createDataFrame(rows, f"split string, {kinds}, n long"), 4)


def _trained(spark, folder, name, **params):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    return training.train_and_evaluate(rows, name, params)


@query
def fit_linear(spark, folder):
    return _metrics_of(_trained(spark, folder, "linear_regression"), spark)


@query
def fit_linear_means(spark, folder):
    """Least squares of the rating on the user mean and the movie mean, training side."""
    train = B.predictions(spark, folder).filter("split = 'train'")
    names = ["user_mean", "movie_mean"]
    stored = materialize(EN.features_array(train, names).select("features", "rating"), "means")
    model = create_model("linear_regression").fit(stored).model
    terms = [*zip(names, model.coefficients.toArray().tolist()), ("intercept", model.intercept)]
    return rounded(spark.createDataFrame(terms, "term string, coefficient double"), 5)


@query
def fit_forest(spark, folder):
    result = _trained(spark, folder, "random_forest")
    return _metrics_of(result, spark)


@query
def fit_boosting(spark, folder):
    result = _trained(spark, folder, "gradient_boosting")
    return _metrics_of(result, spark)


def _stump(spark, folder):
    """One tree of depth one on time parts and the number of genres."""
    names = ["rating_hour", "rating_dayofweek", "rating_month", "num_genres"]
    rows = EN.add_num_genres(EN.add_time_features(views.prep_e(spark, folder)))
    stored = materialize(EN.features_array(rows, names).select("features", "rating"), "stump")
    params = {"n_estimators": 1, "max_depth": 1, "max_features": "all", "bootstrap": False}
    return names, stored, create_model("random_forest", **params).fit(stored)


@query
def fit_stump(spark, folder):
    """The two sides of the best split: what the tree predicts there, and for how many rows."""
    _, rows, model = _stump(spark, folder)
    sides = model.transform(rows).groupBy(F.round("prediction", 6).alias("prediction"))
    return sides.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("mean_rating"))


@query
def boosting_stump(spark, folder):
    """One round of boosting by a tree of depth one, which starts from the mean and so ends at the sides' means."""
    _, rows, _ = _stump(spark, folder)
    params = {"n_estimators": 1, "max_depth": 1, "max_features": "all", "subsample": 1.0}
    model = create_model("gradient_boosting", **params).fit(rows)
    sides = model.transform(rows).groupBy(F.round("prediction", 6).alias("prediction"))
    return sides.agg(F.count(F.lit(1)).alias("n"))


@query
def top_importances(spark, folder):
    names, _, model = _stump(spark, folder)
    return rounded(ME.top_importances(model.importances(names, spark)))


@query
def fit_mlp(spark, folder):
    rows = at_rest(views.prep_e(spark, folder), "prep")
    features = MlpRecipe().fit(rows).transform(rows).select("row_id", "rating", "features")
    model = create_model("multi_layer_perceptron").fit(features)
    history = [(h["epoch"], h["train_loss"], h["val_loss"]) for h in model.history]
    return rounded(spark.createDataFrame(history, "epoch int, train_loss double, val_loss double"))


def _stored_network(spark, folder):
    """Rows, and the stored recipe and network with weights from a formula, so that SQL can follow them."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    path = new_scratch_path(spark, "stored-model")
    recipe = MlpRecipe().fit(rows)
    recipe.save(f"{path}/recipe")
    save_model(spark, formula_network([len(recipe.feature_columns), *FORMULA_WIDTHS]), f"{path}/model")
    return rows, load_recipe(spark, f"{path}/recipe"), load_model(spark, f"{path}/model")


@query
def score_mlp(spark, folder):
    """A stored network applied to stored features."""
    rows, recipe, model = _stored_network(spark, folder)
    return rounded(model.transform(recipe.transform(rows)).select("row_id", "prediction"), 5)


@query
def network_loss(spark, folder):
    """Mean squared error of the stored network over the rows it would be validated on."""
    rows, recipe, model = _stored_network(spark, folder)
    marked = hash_split(rows, 0.1, MlpRegressor().seed + VALIDATION_SEED_SHIFT)
    held_out = recipe.transform(marked.filter("split = 'test'"))
    loss = model.mean_squared_error(held_out)
    return held_out.agg(F.count(F.lit(1)).alias("n")).withColumn("loss", F.round(F.lit(loss), 5))


@query
def written_predictions(spark, folder):
    """Predictions written as CSV and as parquet, read back."""
    rows = prediction_output(B.blend_predictions(spark, folder))
    path = new_scratch_path(spark, "predictions")
    write_predictions(rows, f"{path}/csv")
    write_predictions(rows, f"{path}/parquet", "parquet")
    texts = spark.read.schema(rows.schema).options(header=True, **CSV_READING).csv(f"{path}/csv")
    both = texts.withColumn("fmt", F.lit("csv")).unionByName(read_table(spark, f"{path}/parquet").withColumn("fmt", F.lit("parquet")))
    return rounded(both)


@query
def batch_score(spark, folder):
    """Recipe and network stored, loaded again, and applied to the raw ratings."""
    _, recipe, model = _stored_network(spark, folder)
    return rounded(score(views.ratings_e(spark, folder), views.movies(spark, folder), recipe, model), 5)


@query
def rolling_carried(spark, folder):
    """The boosting recipe fitted on earlier ratings goes on with the later ones."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    ends = rows.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    middle = (ends["a"] + ends["b"]) // 2
    model = BoostingRecipe(vocabulary=["new"]).fit(rows.filter(F.col("timestamp") < middle))
    features = model.continued(rows.filter(F.col("timestamp") >= middle))
    at = [(n, model.feature_columns.index(n)) for n in ("user_rating_rolling_5", "user_rating_rolling_10")]
    return rounded(features.select("row_id", *[F.col("features")[i].alias(n) for n, i in at]))


@query
def rolling_test_side(spark, folder):
    """Rolling means of the test side, in which the training side takes part."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    _, _, test = training.build_features(
        rows, "gradient_boosting", carry_history=True, vocabulary=["new"]
    )
    names = BoostingRecipe(vocabulary=["new"]).fit(rows.limit(1)).feature_columns
    at = [(n, names.index(n)) for n in ("user_rating_rolling_5", "user_rating_rolling_10")]
    return rounded(test.select("row_id", *[F.col("features")[i].alias(n) for n, i in at]))


@query
def row_index(spark, folder):
    """Dense row ids in file order, assigned while scanning CSV files written in event order."""
    path = new_scratch_path(spark, "indexed")
    ordered = views.ratings_e(spark, folder).repartitionByRange("row_id").sortWithinPartitions("row_id")
    write_table(ordered.select(*RATING_COLUMNS), path, "csv")
    return read_ratings_with_row_id(spark, path)


# --- evaluation ----------------------------------------------------------------------------------


@query("prediction_output")
def prediction_rows(spark, folder):
    return rounded(prediction_output(B.blend_predictions(spark, folder)))


@query
def head_predictions(spark, folder):
    return rounded(ME.head_predictions(prediction_output(B.blend_predictions(spark, folder)), 10))


@query
def prediction_summary(spark, folder):
    results = materialize(prediction_output(B.blend_predictions(spark, folder)), "predictions")
    return rounded(ME.prediction_summary(results))


@query
def sketched_quantiles(spark, folder):
    """Are the ranks of sketched quantiles as close as stated, per genre text and over all?"""
    rows = materialize(B.blend_predictions(spark, folder), "blend")
    parts = QU.quantile_sketches(rows, "prediction", ["genres"])
    whole = QU.quantiles(QU.merged_sketches(parts), {f"q{i}": i / 10 for i in range(1, 10)}).first().asDict()
    share = [F.avg((F.col("prediction") <= F.lit(v)).cast("double")).alias(n) for n, v in whole.items()]
    ranks = rows.agg(*share)
    cells = [F.struct(F.lit(n).alias("name"), (F.abs(F.col(n) - i / 10) < 3 * QU.rank_error()).alias("close")) for i, n in enumerate(whole, 1)]
    return ranks.select(F.inline(F.array(*cells)))


@query
def regression_metrics(spark, folder):
    return rounded(ME.regression_metrics(B.blend_predictions(spark, folder)))


@query
def metrics_by_model_split(spark, folder):
    return rounded(B.metrics_by_model_split(spark, folder))


@query
def best_model(spark, folder):
    return ME.best_model(B.metric_rows(spark, folder).filter("split = 'test'"))


@query
def model_comparison(spark, folder):
    return rounded(ME.model_comparison(B.metric_rows(spark, folder).filter("split = 'test'")))


@query
def run_log(spark, folder):
    """Sixteen metric values per run come to the driver as log rows."""
    results: dict[str, dict] = {
        m: {"params": {"seed": B.SEED, "test_size": B.TEST_SIZE, "keys": ["row_id"]}, "metrics": {}}
        for m in B.MODELS
    }
    for row in B.metrics_by_model_split(spark, folder).collect():
        results[row["model"]]["metrics"][row["split"]] = {m: row[m] for m in ME.METRICS}
    return rounded(training.run_log(spark, results, "baseline"))


@query
def overfit_ratio(spark, folder):
    return rounded(ME.overfit_ratio(B.metric_rows(spark, folder)))


@query
def threshold_check(spark, folder):
    tested = B.metric_rows(spark, folder).filter("split = 'test' and model = 'blend'")
    return rounded(ME.threshold_check(tested.select("model", "metric", "value"), TARGETS))


@query
def kfold_metrics(spark, folder):
    """Least squares on leave-one-fold-out means, five folds."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    return rounded(cross_validate_least_squares(rows, 5, features="means"))


@query
def kfold_recipe(spark, folder):
    """The linear recipe's features with statistics from the other folds, five folds."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    return rounded(cross_validate_least_squares(rows, 5, features="recipe"))


@query
def evaluate_stored(spark, folder):
    """Two stored models measured on their split in one read of each side, and one that was never stored."""
    rows = at_rest(views.prep_e(spark, folder), "prep")
    models = new_scratch_path(spark, "models")
    train, _ = train_test(rows)
    for name, keys in {"both_means": ("userId", "movieId"), "user_mean": ("userId",)}.items():
        recipe = MeansRecipe(keys).fit(train)
        recipe.save(f"{models}/{name}/recipe")
        save_model(spark, create_model("linear_regression").fit(recipe.transform(train)), f"{models}/{name}/model")
    results = training.evaluate_stored(rows, models, ["both_means", "user_mean", "never_stored"])
    return rounded(training.run_log(spark, results, "stored"), 5)


@query
def run_log_rewritten(spark, folder):
    """Three runs in one log, one of them written twice: its rows are there once."""
    log = run_log(spark, folder)
    path = new_scratch_path(spark, "log")
    for run in ("first", "second", "first", "third"):
        training.append_run_log(log.withColumn("run", F.lit(run)), path)
    return training.read_run_log(spark, path)


@query
def metrics_file(spark, folder):
    """Metrics as JSON, written twice by one run and once by another, read back."""
    path = new_scratch_path(spark, "metrics")
    rows = B.metric_rows(spark, folder).select("model", "split", "metric", "value")
    for run in ("first", "first", "second"):
        write_metrics(rows.withColumn("run", F.lit(run)), path)
    kinds = "model string, split string, metric string, value double, run string"
    return rounded(spark.read.schema(kinds).json(path))


# --- segments ------------------------------------------------------------------------------------


@query
def bias_by_user_activity(spark, folder):
    """Bounds that split the users of the test tables into all five classes."""
    bounds = {"new": 50, "casual": 60, "regular": 70, "active": 80}
    return rounded(SG.bias_by_user_activity(B.blend_predictions(spark, folder), bounds=bounds))


@query
def bias_by_engagement(spark, folder):
    return rounded(SG.bias_by_engagement(B.blend_predictions(spark, folder), ENGAGEMENT, "high"))


@query
def bias_by_popularity(spark, folder):
    """Popularity counted in the training side only; bounds that split the movies into all five classes."""
    rows = B.blend_predictions(spark, folder)
    bounds = {"unknown": 60, "niche": 70, "cult": 80, "popular": 90}
    return rounded(SG.bias_by_popularity(rows, rows.filter("split = 'train'"), bounds))


@query
def bias_by_engagement_thirds(spark, folder):
    """Engagement levels that a sketch of the users' sizes cuts into thirds."""
    rows = materialize(B.blend_predictions(spark, folder), "blend")
    bounds = SG.engagement_bounds(rows, {"low": 1 / 3, "medium": 2 / 3})
    return rounded(SG.bias_by_engagement(rows, bounds, "high"))


@query
def bias_by_genre(spark, folder):
    return rounded(SG.bias_by_genre(B.blend_predictions(spark, folder)))


@query
def bias_by_weekpart(spark, folder):
    return rounded(SG.bias_by_weekpart(B.blend_predictions(spark, folder)))


@query
def bias_by_daypart(spark, folder):
    return rounded(SG.bias_by_daypart(B.blend_predictions(spark, folder)))


@query
def cold_start_flag(spark, folder):
    return SG.cold_start_flag(views.prep_l(spark, folder))
