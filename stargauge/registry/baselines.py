"""Cheap deterministic predictors, so that evaluation queries need no trained model.

Four models fitted on the training side: the global mean, the user mean, the movie mean, and their
clipped blend user + movie - global.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..operators.metrics import long_metrics, regression_metrics
from ..operators.split import hash_split
from ..sources import views

MODELS = ["global_mean", "user_mean", "movie_mean", "blend"]
SEED = 42
TEST_SIZE = 0.2


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Every processed rating with its split and one prediction column per model."""
    rows = hash_split(views.prep_e(spark, folder), TEST_SIZE, SEED)
    train = rows.filter("split = 'train'")
    users = train.groupBy("userId").agg(F.avg("rating").alias("user_mean"))
    movies = train.groupBy("movieId").agg(F.avg("rating").alias("movie_mean"))
    overall = train.agg(F.avg("rating").alias("global_mean"))
    joined = rows.join(users, "userId", "left").join(movies, "movieId", "left")
    joined = joined.withColumn("global_mean", overall.scalar())
    user = F.coalesce("user_mean", "global_mean")
    movie = F.coalesce("movie_mean", "global_mean")
    blend = S.clip(user + movie - F.col("global_mean"))
    return joined.select(
        *rows.columns,
        F.col("global_mean"),
        user.alias("user_mean"),
        movie.alias("movie_mean"),
        blend.alias("blend"),
    )


def blend_predictions(spark: SparkSession, folder: str) -> DataFrame:
    kept = ["row_id", "userId", "movieId", "rating", "timestamp", "genres", "split"]
    return predictions(spark, folder).select(*kept, F.col("blend").alias("prediction"))


def metrics_by_model_split(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of all models on both sides; the predictions are unpivoted, not recomputed."""
    cells = [
        F.struct(F.lit(m).alias("model"), F.lit(i).alias("position"), F.col(m).alias("prediction"))
        for i, m in enumerate(MODELS)
    ]
    long = predictions(spark, folder).select("split", "rating", F.inline(F.array(*cells)))
    return regression_metrics(long, by=["model", "position", "split"])


def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    return long_metrics(metrics_by_model_split(spark, folder), ["model", "position", "split"])
