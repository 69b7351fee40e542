"""Row-level score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import MAX_RATING, MIN_RATING


def clip(prediction: Column | str, low: float = MIN_RATING, high: float = MAX_RATING) -> Column:
    """Prediction kept between the bounds; null and NaN stay what they are."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    bounded = F.least(F.greatest(prediction, F.lit(low)), F.lit(high))
    return F.when(prediction.isNull() | F.isnan(prediction), prediction).otherwise(bounded)


def absolute_error(prediction: Column | str, actual: Column | str) -> Column:
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    actual = F.col(actual) if isinstance(actual, str) else actual
    return F.abs(prediction - actual)


def mean_interaction(
    user_mean: Column | str = "user_avg_rating", movie_mean: Column | str = "movie_avg_rating"
) -> Column:
    user_mean = F.col(user_mean) if isinstance(user_mean, str) else user_mean
    movie_mean = F.col(movie_mean) if isinstance(movie_mean, str) else movie_mean
    return user_mean * movie_mean


def deviation(mean: Column | str, rating: Column | str = "rating") -> Column:
    """Rating minus a mean; 0 when either is missing."""
    mean = F.col(mean) if isinstance(mean, str) else mean
    rating = F.col(rating) if isinstance(rating, str) else rating
    return F.coalesce(rating - mean, F.lit(0.0))
