"""Expressions over the pipe-separated genre text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import GENRE_SEPARATOR, NO_GENRES, REFERENCE_YEAR


def is_not_sentinel(genres: Column | str = "genres", sentinel: str = NO_GENRES) -> Column:
    """True unless the text equals the sentinel; null genres are kept."""
    genres = F.col(genres) if isinstance(genres, str) else genres
    return ~genres.eqNullSafe(F.lit(sentinel))


def tokens(genres: Column | str = "genres") -> Column:
    """Distinct non-empty genres of a row; an empty array for null or empty text."""
    genres = F.col(genres) if isinstance(genres, str) else genres
    parts = F.split(F.coalesce(genres, F.lit("")), "[|]")
    return F.array_distinct(F.array_remove(parts, ""))


def has_token(genres: Column | str, genre: str) -> Column:
    """Exact-token test as one substring search between separators; no array is built."""
    genres = F.col(genres) if isinstance(genres, str) else genres
    fenced = F.concat(
        F.lit(GENRE_SEPARATOR), F.coalesce(genres, F.lit("")), F.lit(GENRE_SEPARATOR)
    )
    return F.contains(fenced, F.lit(f"{GENRE_SEPARATOR}{genre}{GENRE_SEPARATOR}"))


def has_substring(genres: Column | str, genre: str) -> Column:
    """Literal substring test; false for null text."""
    genres = F.col(genres) if isinstance(genres, str) else genres
    return F.coalesce(F.contains(genres, F.lit(genre)), F.lit(False))


def multi_hot(genres: Column | str, vocabulary: list[str]) -> Column:
    """0/1 array in vocabulary order; genres outside the vocabulary are ignored."""
    if not vocabulary:
        return F.array().cast("array<double>")
    return F.array(*[has_token(genres, g).cast("double") for g in vocabulary])


def num_genres(genres: Column | str = "genres") -> Column:
    return F.size(tokens(genres))


def movie_year(title: Column | str = "title") -> Column:
    """First four-digit year in parentheses, null when there is none."""
    title = F.col(title) if isinstance(title, str) else title
    return F.regexp_extract(title, r"\((\d{4})\)", 1).try_cast("int")


def movie_age(year: Column | str = "movie_year", reference_year: int = REFERENCE_YEAR) -> Column:
    year = F.col(year) if isinstance(year, str) else year
    return F.lit(reference_year) - year.try_cast("int")
