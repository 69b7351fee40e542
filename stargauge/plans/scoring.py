"""Batch scoring: preprocess, stored recipe, model, clip, identifiers and errors."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators.preprocess import preprocess
from ..session import at_rest
from ..sources.readers import CSV_READING, read_movies_csv, read_ratings_with_row_id, read_table
from ..sources.schemas import ROW_ID, require_columns
from ..sources.writers import write_predictions
from .estimators import load_model
from .recipes import RecipeModel, load_recipe
from .recipes.base import Recipe


def prediction_output(scored: DataFrame, add_actual_rating: bool = True) -> DataFrame:
    """Clipped predictions with identifiers, row provenance and, if wanted, actual and error."""
    predicted = S.clip("prediction")
    columns = [predicted.alias("predicted_rating")]
    columns += [F.col(c) for c in ("userId", "movieId", "timestamp") if c in scored.columns]
    if add_actual_rating and "rating" in scored.columns:
        columns.append(F.col("rating").alias("actual_rating"))
        columns.append(S.absolute_error(predicted, "rating").alias("error"))
    if ROW_ID in scored.columns:
        columns.append(F.col(ROW_ID).alias("original_index"))
    return scored.select(*columns)


def score(
    ratings: DataFrame,
    movies: DataFrame | None,
    recipe: RecipeModel | Recipe,
    model: Any,
    add_actual_rating: bool = True,
    carry_history: bool = True,
) -> DataFrame:
    """Score ratings that carry ``row_id``; without ``movies`` they must hold genres already.

    A recipe that is not fitted yet is fitted on the rows to score. A fitted one continues the histories of
    known users unless ``carry_history`` is false.
    """
    require_columns(ratings, [ROW_ID], "ratings")
    processed = preprocess(ratings, movies) if movies is not None else ratings
    if isinstance(recipe, Recipe):
        processed = at_rest(processed, "to-score")
        recipe, carry_history = recipe.fit(processed), False
    features = recipe.continued(processed) if carry_history else recipe.transform(processed)
    return prediction_output(model.transform(features), add_actual_rating)


def score_files(
    spark: SparkSession,
    ratings_path: str,
    movies_path: str,
    recipe_path: str,
    model_path: str,
    output_path: str | None = None,
    add_actual_rating: bool = True,
    fmt: str = "csv",
) -> DataFrame:
    """CSV in, predictions out; missing inputs, recipe or model raise FileNotFoundError."""
    recipe = load_recipe(spark, recipe_path)
    model = load_model(spark, model_path)
    ratings = read_ratings_with_row_id(spark, ratings_path)
    results = score(ratings, read_movies_csv(spark, movies_path), recipe, model, add_actual_rating)
    target = write_predictions(results, output_path, fmt)
    if fmt == "csv":
        return spark.read.schema(results.schema).options(header=True, **CSV_READING).csv(target)
    return read_table(spark, target)
