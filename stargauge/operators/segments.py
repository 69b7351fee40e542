"""Error reports of a predictions table by user, movie, genre and time segments.

``bias`` is actual minus predicted: positive where the model predicts too low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genres as G
from ..functions import timeparts as TP
from .quantiles import approximate_quantiles
from .stats import group_sizes

# Segment names and the row counts that bound them.
USER_ACTIVITY_BOUNDS = {"new": 5, "casual": 30, "regular": 100, "active": 501}
USER_ACTIVITY_TOP = "power"
POPULARITY_BOUNDS = {"unknown": 10, "niche": 100, "cult": 1000, "popular": 5001}
POPULARITY_TOP = "blockbuster"
DAYPARTS = ["late_night", "morning", "afternoon", "evening"]
COLD_USER_RATINGS = 5
COLD_MOVIE_RATINGS = 10


def bias_columns(label: str = "rating", prediction: str = "prediction") -> list[Column]:
    bias = F.col(label) - F.col(prediction)
    return [
        F.avg(bias).alias("mean_bias"),
        F.avg(F.abs(bias)).alias("mean_abs_bias"),
        F.sqrt(F.avg(bias * bias)).alias("rmse"),
        F.count(F.lit(1)).alias("n"),
    ]


def segment_by_bounds(count: Column | str, bounds: dict[str, int], top: str) -> Column:
    """Name of the first segment whose bound lies above ``count``, else ``top``."""
    count = F.col(count) if isinstance(count, str) else count
    chain = None
    for name, bound in bounds.items():
        chain = F.when(count < bound, name) if chain is None else chain.when(count < bound, name)
    return chain.otherwise(top)


def bias_by_user_activity(
    predictions: DataFrame,
    history: DataFrame | None = None,
    bounds: dict[str, int] = USER_ACTIVITY_BOUNDS,
    top: str = USER_ACTIVITY_TOP,
) -> DataFrame:
    """Bias by the number of ratings of the user in ``history`` (default: the table itself)."""
    return _bias_by_count(predictions, history, "userId", bounds, top)


def bias_by_engagement(predictions: DataFrame, bounds: dict[str, int], top: str) -> DataFrame:
    """Bias by engagement level of the user, for bounds the caller chooses."""
    return _bias_by_count(predictions, None, "userId", bounds, top)


def engagement_bounds(predictions: DataFrame, shares: dict[str, float], key: str = "userId") -> dict[str, int]:
    """Upper bounds (exclusive) of levels, so that about the given share of users lies below each.

    The sizes of all users go into one sketch of bounded size.
    """
    sizes = group_sizes(predictions, key, "_size")
    found = approximate_quantiles(sizes, "_size", shares)
    return {name: int(value) + 1 for name, value in found.items() if value is not None}


def bias_by_popularity(
    predictions: DataFrame,
    history: DataFrame | None = None,
    bounds: dict[str, int] = POPULARITY_BOUNDS,
    top: str = POPULARITY_TOP,
) -> DataFrame:
    """Bias by the number of ratings of the movie."""
    return _bias_by_count(predictions, history, "movieId", bounds, top)


def _bias_by_count(predictions, history, key, bounds, top):
    """Error sums shrink to one row per key before sizes are joined; no prediction row moves twice."""
    bias = F.col("rating") - F.col("prediction")
    sums = predictions.groupBy(key).agg(
        F.sum(bias).alias("_bias"),
        F.sum(F.abs(bias)).alias("_abs"),
        F.sum(bias * bias).alias("_square"),
        F.count(F.lit(1)).alias("_rows"),
    )
    if history is None:
        sized = sums.withColumn("_size", F.col("_rows"))
    else:
        sized = sums.join(group_sizes(history, key, "_size"), key, "left").na.fill(0, ["_size"])
    n = F.sum("_rows")
    return sized.groupBy(segment_by_bounds("_size", bounds, top).alias("segment")).agg(
        (F.sum("_bias") / n).alias("mean_bias"),
        (F.sum("_abs") / n).alias("mean_abs_bias"),
        F.sqrt(F.sum("_square") / n).alias("rmse"),
        n.alias("n"),
    )


def bias_by_genre(predictions: DataFrame) -> DataFrame:
    """Bias per genre; a row counts once for each of its genres.

    Errors are summed per genre text first, so only one row per distinct text is exploded.
    """
    bias = F.col("rating") - F.col("prediction")
    per_text = predictions.groupBy("genres").agg(
        F.sum(bias).alias("_bias"),
        F.sum(F.abs(bias)).alias("_abs"),
        F.sum(bias * bias).alias("_square"),
        F.count(F.lit(1)).alias("_rows"),
    )
    n = F.sum("_rows")
    return (
        per_text.withColumn("genre", F.explode(G.tokens("genres")))
        .groupBy("genre")
        .agg(
            (F.sum("_bias") / n).alias("mean_bias"),
            (F.sum("_abs") / n).alias("mean_abs_bias"),
            F.sqrt(F.sum("_square") / n).alias("rmse"),
            n.alias("n"),
        )
    )


def bias_by_weekpart(predictions: DataFrame) -> DataFrame:
    part = F.when(TP.weekday("timestamp") >= 5, "weekend").otherwise("weekday")
    return predictions.groupBy(part.alias("segment")).agg(*bias_columns())


def bias_by_daypart(predictions: DataFrame) -> DataFrame:
    """Bias by six-hour part of the UTC day."""
    part = F.element_at(
        F.array(*[F.lit(p) for p in DAYPARTS]), (F.floor(TP.hour("timestamp") / 6) + 1).cast("int")
    )
    return predictions.groupBy(part.alias("segment")).agg(*bias_columns())


def cold_start_flag(
    df: DataFrame,
    history: DataFrame | None = None,
    user_limit: int = COLD_USER_RATINGS,
    movie_limit: int = COLD_MOVIE_RATINGS,
) -> DataFrame:
    """Mark rows whose user or movie has at most the given number of ratings."""
    source = df if history is None else history
    users = group_sizes(source, "userId", "user_activity")
    movies = group_sizes(source, "movieId", "movie_popularity")
    sized = (
        df.join(users, "userId", "left")
        .join(movies, "movieId", "left")
        .na.fill(0, ["user_activity", "movie_popularity"])
    )
    flag = (F.col("user_activity") <= user_limit) | (F.col("movie_popularity") <= movie_limit)
    return sized.select(*df.columns, "user_activity", "movie_popularity", flag.alias("is_cold"))
