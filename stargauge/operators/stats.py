"""Per-key and global rating statistics: one partial+final aggregation per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genres as G
from ..functions import timeparts as TP

PREFERENCE_EPSILON = 1e-6
#: Genres that recipes with a column per genre accept.
MOST_COLUMNS = 10_000


def sample_std(column: str = "rating") -> Column:
    """Sample standard deviation; 0 for a single row."""
    return F.coalesce(F.stddev_samp(column), F.lit(0.0))


def user_stats(df: DataFrame, std_name: str = "user_std_rating") -> DataFrame:
    """Mean, sample std and count of non-null ratings per user."""
    return _key_stats(df, "userId", "user", std_name)


def movie_stats(df: DataFrame, std_name: str = "movie_std_rating") -> DataFrame:
    """Mean, sample std and count of non-null ratings per movie."""
    return _key_stats(df, "movieId", "movie", std_name)


def _key_stats(df: DataFrame, key: str, prefix: str, std_name: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias(f"{prefix}_avg_rating"),
        sample_std().alias(std_name),
        F.count("rating").alias(f"{prefix}_rating_count"),
    )


def global_mean(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("rating").alias("global_mean"))


def group_sizes(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key, null ratings included (movie popularity, user activity)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def user_item_mean(df: DataFrame) -> DataFrame:
    """Sparse user x movie matrix: repeated ratings of a pair are averaged."""
    return df.groupBy("userId", "movieId").agg(F.avg("rating").alias("rating"))


def weekday_columns() -> list[str]:
    return [f"user_dow_{i}_avg" for i in range(7)]


def month_columns() -> list[str]:
    return [f"user_month_{i}_avg" for i in range(1, 13)]


def _conditional_means(part: Column, values: range) -> list[Column]:
    return [F.coalesce(F.avg(F.when(part == v, F.col("rating"))), F.lit(0.0)) for v in values]


def weekday_means() -> list[Column]:
    return _conditional_means(TP.weekday("timestamp"), range(7))


def month_means() -> list[Column]:
    return _conditional_means(TP.month("timestamp"), range(1, 13))


def genre_preferences(vocabulary: list[str], match: str = "substring") -> list[Column]:
    """Sum of ratings over rows with the genre / (number of such rows + epsilon).

    ``substring`` counts a row when the genre text contains the name anywhere; ``token`` only when
    the name is a whole genre.
    """
    if match not in ("substring", "token"):
        raise ValueError(f"match must be 'substring' or 'token', not {match!r}")
    test = G.has_substring if match == "substring" else G.has_token
    exprs = []
    for genre in vocabulary:
        hit = test("genres", genre)
        total = F.coalesce(F.sum(F.when(hit, F.col("rating")).otherwise(F.lit(0.0))), F.lit(0.0))
        exprs.append(total / (F.sum(hit.cast("int")) + F.lit(PREFERENCE_EPSILON)))
    return exprs


def user_dow_profile(df: DataFrame) -> DataFrame:
    """Mean rating of the user per weekday, seven fixed columns, 0 where the user has none."""
    return df.groupBy("userId").agg(
        *[m.alias(n) for m, n in zip(weekday_means(), weekday_columns())]
    )


def user_month_profile(df: DataFrame) -> DataFrame:
    """Mean rating of the user per calendar month, twelve fixed columns."""
    return df.groupBy("userId").agg(
        *[m.alias(n) for m, n in zip(month_means(), month_columns())]
    )


def user_profile(df: DataFrame) -> DataFrame:
    """Weekday and month profile in one aggregation, so one join attaches both."""
    means = weekday_means() + month_means()
    names = weekday_columns() + month_columns()
    return df.groupBy("userId").agg(*[m.alias(n) for m, n in zip(means, names)])


def user_genre_preference(df: DataFrame, vocabulary: list[str], match: str = "substring") -> DataFrame:
    """One column ``user_<genre>_preference`` per genre; a single pass over the ratings."""
    return df.groupBy("userId").agg(
        *[
            e.alias(f"user_{g}_preference")
            for g, e in zip(vocabulary, genre_preferences(vocabulary, match))
        ]
    )


def user_genre_preference_long(df: DataFrame) -> DataFrame:
    """Exact-token preferences as (userId, genre, preference) rows; any vocabulary size."""
    exploded = df.select("userId", "rating", F.explode(G.tokens("genres")).alias("genre"))
    n = F.count(F.lit(1))
    total = F.coalesce(F.sum("rating"), F.lit(0.0))
    return exploded.groupBy("userId", "genre").agg(
        (total / (n + F.lit(PREFERENCE_EPSILON))).alias("preference")
    )


def genre_vocabulary(df: DataFrame) -> DataFrame:
    """Distinct genres, sorted. Genre texts are de-duplicated before they are exploded."""
    texts = df.select("genres").distinct()
    return texts.select(F.explode(G.tokens("genres")).alias("genre")).distinct().orderBy("genre")


def collect_vocabulary(df: DataFrame) -> list[str]:
    """The sorted vocabulary as a list, for recipes with a column per genre.

    More than ``MOST_COLUMNS`` genres are an error: the sparse recipe keeps its vocabulary in a table.
    """
    found = sorted(row["genre"] for row in genre_vocabulary(df).limit(MOST_COLUMNS + 1).collect())
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} genres: use SparseRecipe, which has no column per genre")
    return found


def group_transform(df: DataFrame, key: str, mean_name: str, std_name: str) -> DataFrame:
    """Group mean and sample std on every row.

    Aggregates first and joins the small result back, where a window would sort a hot key's rows
    inside a single task.
    """
    stats = df.groupBy(key).agg(F.avg("rating").alias(mean_name), sample_std().alias(std_name))
    return df.join(stats, key, "left").select(*df.columns, mean_name, std_name)
