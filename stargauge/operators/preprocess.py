"""Sentinel filter and the ratings-movies join shared by all recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import genres as G
from ..sources.schemas import NO_GENRES, REFERENCE_YEAR, require_columns


def drop_sentinel(movies: DataFrame, sentinel: str = NO_GENRES) -> DataFrame:
    """Movies whose genres are not the sentinel; null genres stay."""
    return movies.filter(G.is_not_sentinel("genres", sentinel))


def preprocess(
    ratings: DataFrame,
    movies: DataFrame,
    how: str = "inner",
    with_year: bool = False,
    reference_year: int = REFERENCE_YEAR,
) -> DataFrame:
    """Attach genres to ratings.

    ``inner`` drops ratings of unknown or sentinel movies, ``left`` keeps them with null genres.
    ``with_year`` adds ``movie_year`` and ``movie_age`` from the title. No join hint is given: the
    optimizer broadcasts the movie side when its measured size allows, and otherwise sort-merges
    with adaptive skew splitting of hot movies.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    require_columns(movies, ["movieId", "genres"], "movies")
    require_columns(ratings, ["movieId"], "ratings")
    kept = drop_sentinel(movies)
    extra = ["genres"]
    if with_year:
        require_columns(movies, ["title"], "movies")
        kept = kept.withColumn("movie_year", G.movie_year("title")).withColumn(
            "movie_age", G.movie_age("movie_year", reference_year)
        )
        extra += ["movie_year", "movie_age"]
    joined = ratings.join(kept.select("movieId", *extra), "movieId", how)
    return joined.select(*ratings.columns, *extra)


def filter_counts(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Original, kept and filtered-out row counts of the preprocess join, without doing the join.

    Both sides shrink to one row per movie before they meet.
    """
    per_movie = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))
    copies = drop_sentinel(movies).groupBy("movieId").agg(F.count(F.lit(1)).alias("copies"))
    joined = per_movie.join(copies, "movieId", "left")
    kept = F.coalesce(F.sum(F.col("n") * F.col("copies")), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return joined.agg(
        total.alias("original_rows"),
        kept.alias("kept_rows"),
        (total - kept).alias("filtered_rows"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count and row count, from a single pass."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(names)],
    )
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(f"_n{i}").alias("non_null"),
            F.col("_rows").alias("row_count"),
        )
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))
