import pytest
from pyspark.sql import functions as F

from stargauge.operators.preprocess import drop_sentinel, filter_counts, preprocess, table_profile
from stargauge.operators.provenance import kept_rows, provenance_join


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_sentinel_movies_go_and_genres_come(ratings, movies):
    result = preprocess(ratings, movies)
    assert result.columns == ["userId", "movieId", "rating", "timestamp", "genres"]
    by_movie = {r["movieId"]: r["genres"] for r in result.collect()}
    assert by_movie == {
        1: "Adventure|Animation|Children|Comedy|Fantasy",
        2: "Adventure|Children|Fantasy",
        4: "Action|Comedy",
    }
    assert result.count() == 5


def test_sentinel_ratings_are_dropped(spark, ratings, movies):
    extra = spark.createDataFrame([(9, 3, 3.0, 1), (9, 99, 3.0, 1)], ratings.schema)
    assert preprocess(ratings.unionByName(extra), movies).count() == 5


def test_empty_ratings(ratings, movies):
    result = preprocess(ratings.limit(0), movies)
    assert result.count() == 0 and "genres" in result.columns


def test_missing_columns_raise_key_error(ratings, movies):
    with pytest.raises(KeyError):
        preprocess(ratings, movies.drop("genres"))
    with pytest.raises(KeyError):
        preprocess(ratings.drop("movieId"), movies)
    with pytest.raises(ValueError):
        preprocess(ratings, movies, "outer")


def test_null_genres_are_kept(spark, ratings):
    movies = spark.createDataFrame([(1, None), (2, "(no genres listed)")], "movieId long, genres string")
    assert [r["movieId"] for r in drop_sentinel(movies).collect()] == [1]
    assert {r["genres"] for r in preprocess(ratings, movies).collect()} == {None}


def test_left_join_keeps_everything(ratings, movies):
    result = preprocess(ratings, movies.filter("movieId <> 2"), "left")
    assert result.count() == 5
    assert result.filter("genres is null").count() == 2


def test_duplicate_movies_fan_out(ratings, movies):
    assert preprocess(ratings, movies.unionByName(movies)).count() == 10


def test_year_and_age(spark, ratings):
    movies = spark.createDataFrame(
        [(1, "Toy Story (1995)", "A"), (2, "No year", "B"), (4, None, "C")],
        "movieId long, title string, genres string",
    )
    result = preprocess(ratings, movies, with_year=True)
    found = {r["movieId"]: (r["movie_year"], r["movie_age"]) for r in result.collect()}
    assert found == {1: (1995, 29), 2: (None, None), 4: (None, None)}


def test_filter_counts(spark, ratings, movies):
    extra = spark.createDataFrame([(9, 3, 3.0, 1), (9, 99, 3.0, 1)], ratings.schema)
    assert rows(filter_counts(ratings.unionByName(extra), movies), "original_rows") == [(7, 5, 2)]
    assert rows(filter_counts(ratings, movies.unionByName(movies)), "original_rows") == [(5, 10, -5)]
    assert rows(filter_counts(ratings.limit(0), movies), "original_rows") == [(0, 0, 0)]


def test_profile(ratings, movies):
    table = preprocess(ratings, movies.filter("movieId <> 2"), "left")
    found = {r["column_name"]: (r["data_type"], r["non_null"], r["row_count"]) for r in table_profile(table).collect()}
    assert found["genres"] == ("string", 3, 5)
    assert found["rating"] == ("double", 5, 5)


def test_kept_rows_are_not_multiplied_by_duplicate_movies(ratings, movies):
    numbered = ratings.withColumn("row_id", F.col("timestamp") - 964982703)
    assert kept_rows(numbered, movies.unionByName(movies)).count() == 5


def test_provenance_keeps_one_row_per_processed_row(spark):
    original = spark.createDataFrame(
        [(i, 1, 1, 7) for i in range(50)] + [(99, 2, 1, 7)],
        "row_id long, userId long, movieId long, timestamp long",
    )
    result = provenance_join(original.drop("row_id"), original)
    assert result.count() == 51
    hot = result.filter("userId = 1").distinct().collect()
    assert len(hot) == 1 and (hot[0]["original_index"], hot[0]["original_matches"]) == (0, 50)
    unmatched = provenance_join(original.drop("row_id"), original.filter("userId = 2"))
    assert unmatched.filter("original_index is null and original_matches = 0").count() == 50


def test_plan_pushes_the_filter_and_prunes_columns(spark):
    from stargauge.sources import views

    from support import SMALL

    plan = views.prep_l(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "p_retailprice" not in plan and "l_extendedprice" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_sentinel_filter_reaches_the_scan(spark, ratings, movies, tmp_path):
    movies.write.parquet(str(tmp_path / "movies"))
    stored = spark.read.parquet(str(tmp_path / "movies"))
    plan = preprocess(ratings, stored)._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualNullSafe(genres,(no genres listed)))" in plan
    assert "ReadSchema: struct<movieId:bigint,genres:string>" in plan
