"""Column additions: time parts, multi-hot genres, interactions and deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genres as G
from ..functions import scores as S
from ..functions import timeparts as TP


def add_time_features(df: DataFrame) -> DataFrame:
    """Month, day, hour, weekday (Monday 0), quarter and year of the rating, in UTC."""
    return df.withColumns(
        {
            "rating_month": TP.month("timestamp"),
            "rating_day": TP.day("timestamp"),
            "rating_hour": TP.hour("timestamp"),
            "rating_dayofweek": TP.weekday("timestamp"),
            "rating_quarter": TP.quarter("timestamp"),
            "rating_year": TP.year("timestamp"),
        }
    )


def add_multi_hot(df: DataFrame, vocabulary: list[str], name: str = "genre_hot") -> DataFrame:
    """One array column aligned with ``vocabulary``: unknown genres drop out, missing ones are 0."""
    return df.withColumn(name, G.multi_hot("genres", vocabulary))


def multi_hot_columns(df: DataFrame, vocabulary: list[str], prefix: str = "genre_") -> DataFrame:
    """The multi-hot block as one column per genre."""
    names = [f"{prefix}{g}" for g in vocabulary]
    if len({n.lower() for n in names}) != len(names):
        raise ValueError("genres must differ by more than letter case to become columns")
    flags = [G.has_token("genres", g).cast("int").alias(n) for g, n in zip(vocabulary, names)]
    return df.select("*", *flags)


def add_num_genres(df: DataFrame) -> DataFrame:
    return df.withColumn("num_genres", G.num_genres("genres"))


def add_movie_age(df: DataFrame, reference_year: int = 2024) -> DataFrame:
    """``movie_age`` from ``movie_year`` where the year is there and the age is not."""
    if "movie_year" not in df.columns or "movie_age" in df.columns:
        return df
    return df.withColumn("movie_age", G.movie_age("movie_year", reference_year))


def add_mean_interaction(df: DataFrame) -> DataFrame:
    return df.withColumn("user_movie_avg_interaction", S.mean_interaction())


def add_rating_deviations(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "user_rating_deviation": S.deviation("user_avg_rating"),
            "movie_rating_deviation": S.deviation("movie_avg_rating"),
        }
    )


def clip_predictions(df: DataFrame, column: str = "prediction") -> DataFrame:
    return df.withColumn(column, S.clip(column))


def features_array(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    """Numeric columns in the given order as one array<double>."""
    return df.withColumn(name, F.array(*[F.col(f"`{c}`").cast("double") for c in columns]))
