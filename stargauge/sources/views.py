"""Rating-shaped views over the star-schema tables in a data folder.

``movies`` comes from ``part``; ``ratings_e`` from ``events`` (unique ``event_id``, real times of
day); ``ratings_l`` from ``lineitem`` and ``orders`` (large, midnight times, no unique row key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import epoch_seconds_ntz
from ..operators.preprocess import preprocess
from .schemas import NO_GENRES, ROW_ID


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def movies(spark: SparkSession, folder: str) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size")
    genres = (
        F.when(F.col("p_partkey") % 23 == 0, NO_GENRES)
        .when(size % 3 == 0, F.split_part(name, F.lit(" "), F.lit(1)))
        .otherwise(F.replace(name, F.lit(" "), F.lit("|")))
    )
    title = F.concat(name, F.lit(" ("), (size + 1950).cast("string"), F.lit(")"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movieId"), title.alias("title"), genres.alias("genres")
    )


def ratings_e(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings from the event stream; ``event_id`` is the carried row id."""
    score = 0.5 * (1 + F.floor("value").cast("long") % 10)
    return table(spark, folder, "events").select(
        F.col("event_id").alias(ROW_ID),
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").cast("long").alias("movieId"),
        score.cast("double").alias("rating"),
        epoch_seconds_ntz("ts").alias("timestamp"),
    )


def ratings_l(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings from order lines."""
    score = 0.5 * (1 + (F.col("l_quantity").cast("long") - 1) % 10)
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        score.cast("double").alias("rating"),
        epoch_seconds_ntz("l_shipdate").alias("timestamp"),
    )


def prep_e(spark: SparkSession, folder: str) -> DataFrame:
    return preprocess(ratings_e(spark, folder), movies(spark, folder))


def prep_l(spark: SparkSession, folder: str) -> DataFrame:
    return preprocess(ratings_l(spark, folder), movies(spark, folder))
