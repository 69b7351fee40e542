"""Rolling means over each user's rating history, exact also for users with a huge history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from ..sources.schemas import ROW_ID, require_columns

def rolling_name(size: int) -> str:
    return f"user_rating_rolling_{size}"


def recent_ratings(
    df: DataFrame,
    reach: int = 10,
    key: str = "userId",
    order: tuple[str, ...] = ("timestamp", ROW_ID),
    columns: tuple[str, ...] = ("movieId", "rating"),
) -> DataFrame:
    """The last ``reach`` rows of every user: what later rows need to continue the rolling means.

    Spark keeps at most ``reach`` rows of a user in each task before it shuffles, so a long history does not
    travel.
    """
    latest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    numbered = df.select(key, *order, *columns).withColumn("_back", F.row_number().over(latest))
    return numbered.filter(F.col("_back") <= reach).drop("_back")


def rolling_means(
    df: DataFrame,
    sizes: tuple[int, ...] = (5, 10),
    key: str = "userId",
    order: tuple[str, ...] = ("timestamp", ROW_ID),
    value: str = "rating",
    exclude_current: bool = False,
    history: DataFrame | None = None,
) -> DataFrame:
    """Mean of the user's last ``n`` ratings for each ``n`` in ``sizes``; fewer rows are allowed.

    The current row is part of the frame unless ``exclude_current``. Columns are named
    ``user_rating_rolling_<n>``. All sizes share one sort.

    A window over a user's history would need all its rows in one task. The rows are therefore cut
    into consecutive ranges of (user, order), which are written once, and each range gets the few
    rows of the user before it as a lead-in, whatever the length of the history. Rows without a user
    form a history of their own.

    ``history`` holds ratings (``key``, ``order`` and ``value``) that take part in the windows and are not
    returned; at equal times they come before the rows of ``df`` unless the rest of the order says otherwise.
    """
    require_columns(df, [key, value, *order], "the rating table")
    if history is None:
        return _ranged(df, sizes, key, order, value, exclude_current)
    past = history.select(key, *order, value).withColumn("_past", F.lit(True))
    both = df.withColumn("_past", F.lit(False)).unionByName(past, allowMissingColumns=True)
    rolled = _ranged(both, sizes, key, order, value, exclude_current)
    return rolled.filter(~F.col("_past")).drop("_past")


def _windowed(df, sizes, keys, order, value, exclude_current):
    by_time = Window.partitionBy(*keys).orderBy(*order)
    shift = 1 if exclude_current else 0
    return df.withColumns(
        {
            rolling_name(n): F.avg(value).over(by_time.rowsBetween(-(n - 1) - shift, -shift))
            for n in sizes
        }
    )


def _ranged(df, sizes, key, order, value, exclude_current):
    """Windows over (user, range) with lead-in rows carried over from the ranges before.

    Sorting by (user, order) spreads a hot user over many partitions. The range number is fixed
    by a checkpoint, because a second range partitioning could draw other bounds.
    """
    reach = max(sizes) - (0 if exclude_current else 1)
    if reach == 0:
        return _windowed(df, sizes, [key], order, value, exclude_current)
    ranged = checkpointed(
        df.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    )
    latest_first = Window.partitionBy(key, "_range").orderBy(*[F.desc(c) for c in order])
    tails = (
        ranged.select(key, "_range", *order, value)
        .withColumn("_back", F.row_number().over(latest_first))
        .filter(F.col("_back") <= reach)
        .drop("_back")
    )
    # A user's tails number at most reach x ranges, whatever the length of the history.
    by_time = Window.partitionBy(key).orderBy("_range", *order)
    carried = F.collect_list(F.struct(*order, value)).over(by_time.rowsBetween(-reach, -1))
    lead_in = (
        tails.select(
            key,
            "_range",
            carried.alias("_carried"),
            F.lag("_range").over(by_time).alias("_previous"),
        )
        .filter(F.col("_previous") < F.col("_range"))
        .select(key, "_range", F.inline("_carried"))
        .withColumn("_lead_in", F.lit(True))
    )
    return (
        _windowed(
            ranged.withColumn("_lead_in", F.lit(False)).unionByName(
                lead_in, allowMissingColumns=True
            ),
            sizes,
            [key, "_range"],
            order,
            value,
            exclude_current,
        )
        .filter(~F.col("_lead_in"))
        .drop("_lead_in", "_range")
    )
