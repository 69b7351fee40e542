import math
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from support import random_processed
from stargauge.functions import genres as G
from stargauge.functions import scores as S
from stargauge.functions import timeparts as TP
from stargauge.functions.vectors import pair_names
from stargauge.operators import encode as EN
from stargauge.operators import scale as SC
from stargauge.operators.factors import singular_value_table, svd_factors
from stargauge.operators.split import hash_folds, hash_split, train_test


def test_time_parts_in_utc_whatever_the_session_zone(spark):
    moments = [0, 964982703, 978307199, -1, -86401, 1709164800]
    df = spark.createDataFrame([(m,) for m in moments], "timestamp long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for r in EN.add_time_features(df).collect():
                t = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=r["timestamp"])
                got = [r[c] for c in ("rating_month", "rating_day", "rating_hour", "rating_dayofweek", "rating_quarter", "rating_year")]
                assert got == [t.month, t.day, t.hour, t.weekday(), (t.month + 2) // 3, t.year]
            ntz = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:15.9' AS ts")
            assert ntz.select(TP.epoch_seconds_ntz("ts").alias("e")).first()["e"] == 1710037815
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_multi_hot_rows_and_counts(processed):
    rows = EN.add_num_genres(EN.add_multi_hot(processed, ["Action", "Adventure", "Comedy", "Drama"])).orderBy("row_id").collect()
    assert [r["genre_hot"] for r in rows[:3]] == [[1, 1, 0, 0], [0, 0, 1, 1], [1, 0, 0, 0]]
    assert [r["num_genres"] for r in rows[:3]] == [2, 2, 1]


def test_genre_edge_cases(spark):
    df = spark.createDataFrame([(None,), ("",), ("a||a",), ("cold",), ("x|old",)], "genres string")
    assert [r["n"] for r in df.select(G.num_genres().alias("n")).collect()] == [0, 0, 1, 1, 2]
    assert [r["t"] for r in df.select(G.has_token("genres", "old").alias("t")).collect()] == [False] * 4 + [True]
    assert [r["t"] for r in df.select(G.has_substring("genres", "old").alias("t")).collect()] == [False] * 3 + [True] * 2


def test_unseen_and_missing_genres_align(processed):
    hot = EN.multi_hot_columns(processed, ["Action", "Western"])
    assert hot.agg(F.sum("genre_Action"), F.sum("genre_Western")).first()[:] == (4, 0)
    with pytest.raises(ValueError):
        EN.multi_hot_columns(processed, ["Drama", "drama"])


def test_movie_age_from_bad_years(spark):
    df = spark.createDataFrame([("1995",), ("n/a",), (None,)], "movie_year string")
    assert [r["movie_age"] for r in EN.add_movie_age(df).collect()] == [29, None, None]
    assert EN.add_movie_age(df.withColumn("movie_age", F.lit(1))).first()["movie_age"] == 1


def test_scores(spark):
    df = spark.createDataFrame([(0.1, 2.0), (9.0, 4.0), (3.0, None)], "prediction double, rating double")
    assert [r["prediction"] for r in EN.clip_predictions(df).collect()] == [0.5, 5.0, 3.0]
    holes = spark.createDataFrame([(None,), (float("nan"),)], "prediction double")
    null, nan = [r["prediction"] for r in EN.clip_predictions(holes).collect()]
    assert null is None and math.isnan(nan)
    assert df.select(S.deviation("prediction").alias("d")).collect()[2]["d"] == 0.0


def test_scaler_uses_population_std_and_keeps_constants(spark):
    x = np.array([[1.0, 7.0, 1e9], [2.0, 7.0, 1e9 + 1], [4.0, 7.0, 1e9 + 2]])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, features array<double>").repartition(3)
    moments = SC.array_moments(df, "features")
    got = np.array([r["features"] for r in SC.scale_array(df, "features", moments).orderBy("i").collect()])
    std = x.std(axis=0)
    std[1] = 1
    assert np.allclose(got, (x - x.mean(axis=0)) / std)
    again = SC.column_moments(df, [F.col("features")[i] for i in range(3)])
    assert np.allclose(again.mean, moments.mean) and np.allclose(again.scale, moments.scale)
    with pytest.raises(ValueError):
        SC.array_moments(df.limit(0), "features")


def test_pairwise_interactions_order(spark):
    df = spark.createDataFrame([([2.0, 3.0, 5.0],)], "features array<double>")
    assert SC.pairwise_interactions(df, "features").first()["features"] == [2, 3, 5, 6, 10, 15]
    assert pair_names(["a", "b", "c"]) == ["a", "b", "c", "a b", "a c", "b c"]


def test_interactions_scaled_in_one_pass(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 4)).round(3)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, features array<double>")
    moments = SC.array_moments(df, "features", expand=True)
    got = np.array([r["features"] for r in SC.scaled_interactions(df, "features", moments).orderBy("i").collect()])
    pairs = [x[:, i] * x[:, j] for i in range(4) for j in range(i + 1, 4)]
    wide = np.column_stack([x, *pairs])
    assert np.allclose(got, (wide - wide.mean(axis=0)) / wide.std(axis=0))


def matrix_of(pdf):
    return pdf.pivot_table(values="rating", index="userId", columns="movieId", fill_value=0)


def test_svd_matches_numpy(spark):
    df, pdf = random_processed(spark, rows=100)
    dense = matrix_of(pdf)
    result = svd_factors(df, 5, n_iter=3)
    u = result.user_factors.toPandas().sort_values("userId")
    v = result.movie_factors.toPandas().sort_values("movieId")
    assert list(u["userId"]) == list(dense.index) and list(v["movieId"]) == list(dense.columns)
    left, right = np.stack(u["factors"]), np.stack(v["factors"])
    exact = np.linalg.svd(dense.to_numpy(), full_matrices=False)
    assert np.allclose(result.singular_values, exact[1][:5])
    best = (exact[0][:, :5] * exact[1][:5]) @ exact[2][:5]
    assert np.allclose(left @ right.T, best, atol=1e-8)
    assert np.allclose(right.T @ right, np.eye(5), atol=1e-9)
    assert all(column[np.abs(column).argmax()] > 0 for column in right.T)
    values = {r["component"]: r["singular_value"] for r in singular_value_table(result).collect()}
    assert values[0] == pytest.approx(exact[1][0])


def test_svd_pads_low_rank_and_rejects_too_many_components(spark):
    rows = [(i, u, m, float(u * m), 0, "A") for i, (u, m) in enumerate((u, m) for u in range(1, 5) for m in range(1, 4))]
    df = spark.createDataFrame(rows, "row_id long, userId long, movieId long, rating double, timestamp long, genres string")
    result = svd_factors(df, 3)
    assert result.singular_values[0] == pytest.approx(np.sqrt(30 * 14))
    assert result.singular_values[1:] == [0.0, 0.0]
    assert all(len(r["factors"]) == 3 for r in result.user_factors.collect())
    with pytest.raises(ValueError):
        svd_factors(df, 4)


def test_hash_split_is_stable(random_rows):
    df, _ = random_rows
    first = {r["row_id"] for r in train_test(df)[1].collect()}
    second = {r["row_id"] for r in train_test(df.repartition(7))[1].collect()}
    assert first == second and 30 < len(first) < 90
    assert hash_split(df, seed=1).filter("split = 'test'").count() != 0
    train, test = train_test(df)
    assert train.count() + test.count() == 300
    with pytest.raises(ValueError):
        hash_split(df, test_size=0.0)


def test_folds_cover_all_rows(random_rows):
    counts = hash_folds(random_rows[0], 5).groupBy("fold").count().collect()
    assert {r["fold"] for r in counts} == {0, 1, 2, 3, 4} and sum(r["count"] for r in counts) == 300


def test_svd_over_many_tiles_equals_one(spark, monkeypatch):
    from stargauge.operators import factors as T

    df, frame = random_processed(spark, rows=900, users=40, items=25, seed=11)
    dense = frame.pivot_table(values="rating", index="userId", columns="movieId", fill_value=0.0)
    exact = np.linalg.svd(dense.to_numpy(), compute_uv=False)
    monkeypatch.setattr(T, "BLOCK_KEYS", 4)
    monkeypatch.setattr(T, "TILE_CELLS", 8)
    monkeypatch.setattr(T, "FAN_IN", 2)
    cells = T.user_item_mean(df)
    tiles = T.cut_tiles(cells)
    assert tiles.movies.blocks >= 7 and tiles.users.blocks >= 10
    result = svd_factors(df, 25)
    assert np.allclose(result.singular_values, exact[:25], atol=1e-8)
    users = {r["userId"]: np.array(r["factors"]) for r in result.user_factors.collect()}
    movies = {r["movieId"]: np.array(r["factors"]) for r in result.movie_factors.collect()}
    for r in cells.collect():
        assert abs(users[r["userId"]] @ movies[r["movieId"]] - r["rating"]) < 1e-7


def test_tiles_stay_where_they_are(spark, monkeypatch):
    from stargauge.operators import factors as T

    df, _ = random_processed(spark, rows=200, users=12, items=8)
    monkeypatch.setattr(T, "TILE_CELLS", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tiles = T.cut_tiles(T.user_item_mean(df))
        product = T._product(tiles, T._random_basis(tiles.movies, 3, 1), 3, to_users=True)
        plan = product._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tile_side = plan.split("SortMergeJoin")[1].split("Scan ExistingRDD")[0]
    assert tiles.users.blocks > 1 and "Exchange" not in tile_side


def test_svd_leaves_out_rows_without_keys(spark):
    rows = [(1, 1, 2.0), (1, 2, 3.0), (2, 1, 4.0), (None, 1, 5.0), (2, None, 5.0), (3, 2, None)]
    result = svd_factors(spark.createDataFrame(rows, "userId long, movieId long, rating double"), 2)
    exact = np.linalg.svd(np.array([[2.0, 3.0], [4.0, 0.0], [0.0, 0.0]]), compute_uv=False)
    assert np.allclose(result.singular_values, exact) and result.user_factors.count() == 3


@pytest.mark.parametrize("name", ["svd_energy", "svd_reconstruction"])
def test_svd_queries_cover_every_cell_of_the_given_ratings(spark, name):
    from stargauge.operators.stats import user_item_mean
    from stargauge.registry.spark_queries import QUERIES
    from stargauge.sources import views
    from support import SMALL

    cells = {(r["userId"], r["movieId"]): r["rating"] for r in user_item_mean(views.prep_e(spark, SMALL)).collect()}
    got = QUERIES[name](spark, SMALL).collect()
    if name == "svd_energy":
        assert abs(got[0]["energy"] - sum(x * x for x in cells.values())) < 1e-3
    else:
        assert {(r["userId"], r["movieId"]) for r in got} == set(cells) and len(got) == len(cells)
        assert all(abs(r["rating"] - cells[r["userId"], r["movieId"]]) < 1e-4 for r in got)
