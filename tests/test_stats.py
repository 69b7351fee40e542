import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.operators import stats as ST
from stargauge.operators.attach import attach, attach_factors, attach_zero, cold_start_defaults, fill_defaults


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_user_and_movie_statistics(processed):
    users = by_key(ST.user_stats(processed), "userId")
    assert [users[u]["user_avg_rating"] for u in (1, 2, 3)] == [4.5, 3.75, 3.0]
    assert users[1]["user_rating_count"] == 2
    assert users[1]["user_std_rating"] == pytest.approx(np.std([4, 5], ddof=1))
    movies = by_key(ST.movie_stats(processed, "movie_rating_std"), "movieId")
    assert movies[1]["movie_avg_rating"] == 3.5 and movies[2]["movie_avg_rating"] == 3.75
    assert movies[4]["movie_rating_std"] == 0.0


def test_null_ratings_count_as_rows_only(spark):
    rows = spark.createDataFrame([(1, None), (1, 4.0), (2, None)], "userId long, rating double")
    stats = by_key(ST.user_stats(rows), "userId")
    assert stats[1]["user_rating_count"] == 1 and stats[1]["user_avg_rating"] == 4.0
    assert stats[2] == {"userId": 2, "user_avg_rating": 0.0, "user_std_rating": 0.0, "user_rating_count": 0}
    assert by_key(ST.group_sizes(rows, "userId", "n"), "userId")[1]["n"] == 2


def test_popularity_activity(processed):
    popularity = by_key(ST.group_sizes(processed, "movieId", "n"), "movieId")
    assert {k: v["n"] for k, v in popularity.items()} == {1: 2, 2: 2, 3: 1, 4: 1}


def test_profiles_have_fixed_columns(processed):
    profile = ST.user_profile(processed)
    assert profile.columns == ["userId", *ST.weekday_columns(), *ST.month_columns()]
    row = by_key(profile, "userId")[1]
    # 2000-07-30 was a Sunday.
    assert row["user_dow_6_avg"] == 4.5 and row["user_month_7_avg"] == 4.5
    assert sum(v for k, v in row.items() if k != "userId") == 9.0


def test_genre_preferences_substring_and_token(spark):
    rows = spark.createDataFrame(
        [(1, 4.0, "cold|new"), (1, 2.0, "old"), (2, 3.0, None)], "userId long, rating double, genres string"
    )
    sub = by_key(ST.user_genre_preference(rows, ["cold", "old"]), "userId")
    tok = by_key(ST.user_genre_preference(rows, ["cold", "old"], "token"), "userId")
    assert sub[1]["user_old_preference"] == pytest.approx(6 / (2 + 1e-6))
    assert tok[1]["user_old_preference"] == pytest.approx(2 / (1 + 1e-6))
    assert sub[2]["user_cold_preference"] == 0.0
    long = {(r["userId"], r["genre"]): r["preference"] for r in ST.user_genre_preference_long(rows).collect()}
    assert long[(1, "old")] == pytest.approx(2 / (1 + 1e-6)) and (2, "old") not in long
    with pytest.raises(ValueError):
        ST.genre_preferences(["cold"], "fuzzy")


def test_user_item_mean_averages_repeats(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, 2, 5.0)], "userId long, movieId long, rating double")
    found = {(r["userId"], r["movieId"]): r["rating"] for r in ST.user_item_mean(rows).collect()}
    assert found == {(1, 1): 3.0, (1, 2): 5.0}


def test_vocabulary_is_sorted_and_of_any_size(spark):
    rows = spark.createDataFrame([("b|a",), ("",), (None,), ("a||c",)], "genres string")
    assert ST.collect_vocabulary(rows) == ["a", "b", "c"]
    many = spark.range(6000).selectExpr("concat('g', id) AS genres")
    assert len(ST.collect_vocabulary(many)) == 6000


def test_group_transform_matches_pandas(random_rows):
    df, pdf = random_rows
    got = ST.group_transform(df, "userId", "m", "s").toPandas().sort_values("row_id")
    groups = pdf.groupby("userId")["rating"]
    assert np.allclose(got["m"], groups.transform("mean"))
    assert np.allclose(got["s"], groups.transform("std").fillna(0))


def test_cold_start_fill_and_zero_fill(spark, processed):
    rows = spark.createDataFrame([(1,), (999,)], "userId long")
    filled = fill_defaults(
        attach(rows, ST.user_stats(processed), "userId"), cold_start_defaults(3.75, "user")
    )
    cold = by_key(filled, "userId")[999]
    assert (cold["user_avg_rating"], cold["user_std_rating"], cold["user_rating_count"]) == (3.75, 0.0, 1.0)
    zero = by_key(attach_zero(rows, ST.user_stats(processed), "userId"), "userId")[999]
    assert zero["user_avg_rating"] == 0.0 and zero["user_rating_count"] == 0
    factors = spark.createDataFrame([(1, [1.0, 2.0])], "userId long, factors array<double>")
    vectors = by_key(attach_factors(rows, factors, "userId", "factors", 2), "userId")
    assert vectors[999]["factors"] == [0.0, 0.0] and vectors[1]["factors"] == [1.0, 2.0]
    with pytest.raises(KeyError):
        attach(rows, ST.movie_stats(processed), "movieId")


def test_results_do_not_depend_on_partitioning(random_rows):
    df, _ = random_rows
    seen = set()
    for parts in (1, 3, 17):
        frame = ST.user_profile(df.repartition(parts)).join(ST.user_stats(df.repartition(parts)), "userId")
        rounded = frame.select("userId", *[F.round(F.col(c), 9).alias(c) for c in frame.columns if c != "userId"])
        seen.add(tuple(sorted(tuple(r) for r in rounded.collect())))
    assert len(seen) == 1
