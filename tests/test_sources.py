import json
from types import SimpleNamespace

import numpy as np
import pytest

from stargauge.plans.estimators import create_model, save_model
from stargauge.plans.recipes import MlpRecipe
from stargauge.plans.scoring import score, score_files
from stargauge.operators.preprocess import preprocess
from stargauge.session import shared_folder
from stargauge.sources import readers as R
from stargauge.sources import writers as W


def test_quoted_titles(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text('movieId,title,genres\n1,"American President, The (1995)",Comedy|Drama\n2,"Say ""hi"" (1990)",\n')
    rows = R.read_movies_csv(spark, str(path)).orderBy("movieId").collect()
    assert rows[0]["title"] == "American President, The (1995)"
    assert rows[1]["title"] == 'Say "hi" (1990)' and rows[1]["genres"] is None
    with pytest.raises(FileNotFoundError):
        R.read_movies_csv(spark, str(tmp_path / "none.csv"))
    path.write_text("movieId,genres\n1,Comedy|Drama\n")
    assert R.read_movies_csv(spark, str(path), with_title=False).first()[:] == (1, "Comedy|Drama")


def test_written_csv_reads_back(spark, tmp_path):
    rows = [(1, 'Say "Hi", you (1999)', "Comedy|Drama"), (2, "", "A"), (3, None, None), (4, '"', "a,b"), (5, "back\\slash", '""')]
    W.write_table(spark.createDataFrame(rows, "movieId long, title string, genres string"), str(tmp_path / "m"), "csv")
    got = R.read_movies_csv(spark, str(tmp_path / "m")).orderBy("movieId").collect()
    assert [tuple(r) for r in got] == rows


def test_row_ids_follow_file_order(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    lines = [f"{i % 50},{i % 7},3.5,{i}" for i in range(20000)]
    path.write_text("userId,movieId,rating,timestamp\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = R.read_ratings_with_row_id(spark, str(path))
        assert rows.columns == ["userId", "movieId", "rating", "timestamp", "row_id"]
        assert rows.filter("row_id <> timestamp").count() == 0 and rows.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_ids_are_dense_over_partitions(spark):
    df = spark.range(1000).repartition(7)
    ids = sorted(r["row_id"] for r in R.assign_row_id(df).collect())
    assert ids == list(range(1000))


def test_feature_table_round_trip(spark, processed, tmp_path):
    model = MlpRecipe().fit(processed)
    W.write_feature_table(model.transform(processed), model.feature_columns, str(tmp_path / "f"))
    table, names = R.read_table(spark, str(tmp_path / "f")), model.feature_columns
    again, stored = W.read_feature_table(spark, str(tmp_path / "f"))
    assert stored == names and table.count() == 6
    flat = W.feature_names_flat(again, stored)
    assert flat.columns == [*names, "rating"] and flat.count() == 6
    W.write_feature_table(model.transform(processed), None, str(tmp_path / "g"))
    assert W.read_feature_table(spark, str(tmp_path / "g"))[1][0] == "f0"
    with pytest.raises(ValueError):
        W.feature_names_flat(again, ["a", "A"])
    with pytest.raises(FileNotFoundError):
        R.read_table(spark, str(tmp_path / "none"))


def test_metrics_json(spark, tmp_path):
    nested = {"model": {"test": {"rmse": np.float64(0.5), 1: np.array([1, 2])}, "kind": object}}
    text = json.loads(W.metrics_to_json(nested))
    assert text["model"]["test"] == {"rmse": 0.5, "1": [1, 2]} and isinstance(text["model"]["kind"], str)
    W.write_metrics(spark.createDataFrame([("a", 1.5)], "model string, value double"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["value"] == 1.5


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"{master}-{folder}")


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(Session("spark://host:1", "s3a://bucket/work/")) == "s3a://bucket/work"
    local = Session("local[2]", None)
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host:1", None))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Raw CSV files with copies and a sentinel movie, plus a stored recipe and network."""
    root = tmp_path_factory.mktemp("scoring")
    rng = np.random.default_rng(0)
    rows = [(int(u), int(m), float(r) / 2, 964982703 + i) for i, (u, m, r) in enumerate(zip(rng.integers(1, 9, 120), rng.integers(1, 6, 120), rng.integers(1, 11, 120)))]
    rows += [rows[0], rows[0]]
    text = "\n".join(f"{u},{m},{r},{t}" for u, m, r, t in rows)
    (root / "ratings.csv").write_text(f"userId,movieId,rating,timestamp\n{text}\n")
    (root / "movies.csv").write_text(
        'movieId,title,genres\n1,"A, The (1990)",Action\n2,B,Drama|Action\n3,C,(no genres listed)\n4,D,Comedy\n5,E,Drama\n'
    )
    ratings = R.read_ratings_with_row_id(spark, str(root / "ratings.csv"))
    prepared = preprocess(ratings, R.read_movies_csv(spark, str(root / "movies.csv")))
    recipe = MlpRecipe().fit(prepared)
    model = create_model("multi_layer_perceptron", hidden_dims=[8], epochs=2, shards=1).fit(recipe.transform(prepared))
    recipe.save(str(root / "recipe"))
    save_model(spark, model, str(root / "model"))
    return root, rows


def test_scoring_files(spark, stored):
    root, rows = stored
    paths = [str(root / n) for n in ("ratings.csv", "movies.csv", "recipe", "model", "out.csv")]
    results = score_files(spark, *paths).orderBy("original_index").collect()
    kept = [i for i, r in enumerate(rows) if r[1] != 3]
    assert [r["original_index"] for r in results] == kept
    for r in results:
        user, movie, rating, stamp = rows[r["original_index"]]
        assert (r["userId"], r["movieId"], r["timestamp"], r["actual_rating"]) == (user, movie, stamp, rating)
        assert 0.5 <= r["predicted_rating"] <= 5.0
        assert r["error"] == pytest.approx(abs(r["predicted_rating"] - rating))
    paths[3] = str(root / "no-model")
    with pytest.raises(FileNotFoundError):
        score_files(spark, *paths)


def test_scoring_without_actuals_and_without_movies(spark, stored):
    from stargauge.plans.estimators import load_model
    from stargauge.plans.recipes import load_recipe

    root, _ = stored
    recipe, model = load_recipe(spark, str(root / "recipe")), load_model(spark, str(root / "model"))
    ready = spark.createDataFrame(
        [(0, 1, 1, 4.0, 964982703, "Action")],
        "row_id long, userId long, movieId long, rating double, timestamp long, genres string",
    )
    out = score(ready, None, recipe, model, add_actual_rating=False)
    assert out.columns == ["predicted_rating", "userId", "movieId", "timestamp", "original_index"]
    assert out.count() == 1
    with pytest.raises(KeyError):
        score(ready.drop("row_id"), None, recipe, model)


def test_predictions_do_not_depend_on_batch_size(spark, stored):
    from stargauge.plans.estimators import load_model
    from stargauge.plans.recipes import load_recipe

    root, _ = stored
    recipe, model = load_recipe(spark, str(root / "recipe")), load_model(spark, str(root / "model"))
    ratings = R.read_ratings_with_row_id(spark, str(root / "ratings.csv"))
    movies = R.read_movies_csv(spark, str(root / "movies.csv"))
    seen = []
    for size in ("3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            rows = score(ratings, movies, recipe, model).orderBy("original_index").collect()
            seen.append([r["predicted_rating"] for r in rows])
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert np.allclose(seen[0], seen[1])
