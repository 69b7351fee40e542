"""Which input rows survive preprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import ROW_ID, require_columns
from .preprocess import drop_sentinel

RATING_KEY = ["userId", "movieId", "timestamp"]


def kept_rows(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Row ids of the ratings the preprocess join keeps (a semi join: no duplicates arise)."""
    require_columns(ratings, [ROW_ID, "movieId"], "ratings")
    return ratings.join(drop_sentinel(movies).select("movieId"), "movieId", "left_semi").select(ROW_ID)


def provenance_join(
    processed: DataFrame, original: DataFrame, keys: list[str] | None = None, fan_out: bool = False
) -> DataFrame:
    """Left join of processed rows to the original rows with the same (user, movie, time).

    With ``fan_out`` every pair of equal keys gives a row, as a plain join does. Else: copies of one key would multiply in a row-by-row join. The originals are reduced to one row per
    key first, holding the smallest row id and the number of originals, so every processed row
    comes out once and the fan-out is visible as ``original_matches``.
    """
    keys = keys or RATING_KEY
    if fan_out:
        rows = original.select(*keys, F.col(ROW_ID).alias("original_index"))
        return processed.join(rows, keys, "left").select(*processed.columns, "original_index")
    per_key = original.groupBy(*keys).agg(
        F.min(ROW_ID).alias("original_index"), F.count(F.lit(1)).alias("original_matches")
    )
    return processed.join(per_key, keys, "left").select(
        *processed.columns,
        "original_index",
        F.coalesce("original_matches", F.lit(0)).alias("original_matches"),
    )
