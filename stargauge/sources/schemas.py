"""Declared table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RATINGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

MOVIES_WITHOUT_TITLE = T.StructType([f for f in MOVIES if f.name != "title"])

# Fixed values.
NO_GENRES = "(no genres listed)"
GENRE_SEPARATOR = "|"
MIN_RATING = 0.5
MAX_RATING = 5.0
REFERENCE_YEAR = 2024

ROW_ID = "row_id"


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    """KeyError naming the first column of ``names`` that ``df`` lacks."""
    for name in names:
        if name not in df.columns:
            raise KeyError(f"{what} lacks the required column {name!r}")
