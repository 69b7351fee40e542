import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.functions import network as N
from stargauge.functions.vectors import array_map, array_score
from stargauge.operators.split import hash_folds
from stargauge.plans.estimators import available_models, create_model, load_model, save_model
from stargauge.plans.mlp import MlpRegressor
from stargauge.plans.training import (
    append_run_log,
    cross_validate,
    evaluate_stored,
    metric_rows,
    run_log,
    run_models,
    train_and_evaluate,
)
from stargauge.plans.recipes import LinearRecipe
from stargauge.session import materialize


@pytest.fixture(scope="module")
def learnable(spark):
    """500 rows with a smooth, noisy target over ten features."""
    rng = np.random.default_rng(42)
    x = rng.normal(size=(500, 10))
    y = x @ rng.normal(size=10) + 2 * np.sin(x[:, 0]) * np.cos(x[:, 1]) + 0.1 * rng.normal(size=500)
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return materialize(spark.createDataFrame(rows, "row_id long, features array<double>, rating double"), "learnable")


def mse(model, df):
    gap = F.col("prediction") - F.col("rating")
    return model.transform(df).agg(F.avg(gap * gap)).first()[0]


def variance(df):
    return df.agg(F.var_pop("rating")).first()[0]


CASES = {
    "linear_regression": {},
    "random_forest": {"n_estimators": 10, "max_depth": 6, "min_samples_split": 5, "n_jobs": -1},
    "gradient_boosting": {"n_estimators": 10, "learning_rate": 0.3, "max_depth": 4},
    "multi_layer_perceptron": {"hidden_dims": [32], "epochs": 15, "learning_rate": 0.02, "batch_size": 32, "shards": 2},
}


@pytest.mark.parametrize("name", list(CASES))
def test_models_learn_and_come_back_from_disk(spark, learnable, name, tmp_path):
    model = create_model(name, **CASES[name]).fit(learnable)
    assert mse(model, learnable) < 0.6 * variance(learnable)
    path = save_model(spark, model, str(tmp_path / name))
    again = load_model(spark, path)
    assert mse(again, learnable) == pytest.approx(mse(model, learnable))


def test_registry():
    assert available_models() == ["linear_regression", "random_forest", "gradient_boosting", "multi_layer_perceptron"]
    assert create_model("Random_Forest").estimator.getNumTrees() == 100
    boosted = create_model("GRADIENT_BOOSTING").estimator
    assert boosted.getMaxIter() == 150 and boosted.getFeatureSubsetStrategy() == "0.8" and boosted.getSubsamplingRate() == 0.8
    with pytest.raises(ValueError, match="linear_regression"):
        create_model("nearest_neighbour")
    with pytest.raises(ValueError):
        create_model("random_forest", colour="red")


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))


def test_importances(spark, learnable):
    model = create_model("random_forest", n_estimators=5, max_depth=4).fit(learnable)
    table = model.importances([f"x{i}" for i in range(10)], spark)
    assert table.count() == 10 and table.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_network_is_reproducible_and_independent_of_partitions(learnable):
    network = MlpRegressor(hidden_dims=[8], epochs=2, batch_size=32, shards=3)
    first, second = network.fit(learnable), network.fit(learnable.repartition(7))
    assert all(np.allclose(first.params[k], second.params[k]) for k in first.params)
    other = MlpRegressor(hidden_dims=[8], epochs=2, batch_size=32, shards=3, seed=1).fit(learnable)
    assert not np.allclose(first.params["w0"], other.params["w0"])


def test_network_rejects_empty_and_ragged_input(spark, learnable):
    with pytest.raises(ValueError):
        MlpRegressor(epochs=1).fit(learnable.limit(0))
    ragged = spark.createDataFrame([(0, [1.0], 1.0), (1, [1.0, 2.0], 1.0)], learnable.schema)
    with pytest.raises(Exception, match="differ in length|mismatch|matmul"):
        MlpRegressor(epochs=1, shards=1).fit(ragged, ragged)


def test_early_stopping_and_rate_halving(learnable):
    model = MlpRegressor(hidden_dims=[4], epochs=40, patience=2, learning_rate=0.5, shards=1, batch_size=64).fit(learnable)
    losses = [h["val_loss"] for h in model.history]
    assert len(losses) < 40 and len(losses) == losses.index(min(losses)) + 3
    frozen = MlpRegressor(hidden_dims=[4], epochs=9, patience=20, learning_rate=0.0, dropout_rate=0.0, shards=1)
    assert MlpRegressor.fit(frozen, learnable).history[-1]["rate"] == 0.0


def test_best_weights_are_kept(learnable):
    network = MlpRegressor(hidden_dims=[4], epochs=6, learning_rate=0.3, shards=1, batch_size=64)
    model = network.fit(learnable, learnable)
    assert model.mean_squared_error(learnable) == pytest.approx(min(h["val_loss"] for h in model.history))


@pytest.mark.parametrize("rows", [1, 2, 33, 65])
def test_odd_shard_sizes_use_every_row(learnable, rows):
    part = materialize(learnable.filter(F.col("row_id") < rows), "odd")
    model = MlpRegressor(hidden_dims=[4], epochs=1, batch_size=32, shards=1).fit(part, part)
    assert np.isfinite(model.history[0]["train_loss"])


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(12, 3)), rng.normal(size=12)
    params = N.init_params(3, [4, 3], 1)

    def loss(p):
        out = x
        for i in range(2):
            z = out @ p[f"w{i}"] + p[f"b{i}"]
            unit = (z - z.mean(axis=0)) / np.sqrt(z.var(axis=0) + N.NORM_EPS)
            out = np.maximum(unit * p[f"gain{i}"] + p[f"shift{i}"], 0)
        return np.mean(((out @ p["w2"] + p["b2"])[:, 0] - y) ** 2)

    trained = [k for k in params if N.is_trained_by_gradient(k)]
    moments = {k: np.zeros_like(params[k]) for k in trained}
    squares = {k: np.zeros_like(params[k]) for k in trained}
    copy = {k: v.copy() for k, v in params.items()}
    N.gradient_step(copy, moments, squares, 1, x, y, 2, 0.0, 0.0, 0.0, rng)
    for name in trained:
        for at in list(np.ndindex(params[name].shape))[:5]:
            up = {k: v.copy() for k, v in params.items()}
            down = {k: v.copy() for k, v in params.items()}
            up[name][at] += 1e-6
            down[name][at] -= 1e-6
            slope = (loss(up) - loss(down)) / 2e-6
            assert moments[name][at] / (1 - N.BETA1) == pytest.approx(slope, abs=1e-5)


def test_folded_inference_equals_layer_by_layer():
    rng = np.random.default_rng(2)
    params = N.init_params(3, [5], 0)
    params["mean0"], params["var0"] = rng.normal(size=5), rng.uniform(0.5, 2, 5)
    params["gain0"], params["shift0"] = rng.normal(size=5), rng.normal(size=5)
    x = rng.normal(size=(7, 3))
    z = x @ params["w0"] + params["b0"]
    unit = (z - params["mean0"]) / np.sqrt(params["var0"] + N.NORM_EPS)
    out = np.maximum(unit * params["gain0"] + params["shift0"], 0) @ params["w1"] + params["b1"]
    assert np.allclose(N.infer(N.folded_layers(params, 1), x), out[:, 0])


def test_run_records_failures_and_goes_on(spark, random_rows, tmp_path):
    rows = materialize(random_rows[0], "run-rows")
    results = run_models(
        rows,
        {
            "random_forest": {"recipe_params": {"n_svd_components": 500}},
            "linear_regression": {},
        },
        save_to=str(tmp_path / "models"),
    )
    assert results["random_forest"]["error"].startswith("ValueError")
    assert results["linear_regression"]["metrics"]["train"]["n"] > 200
    table = metric_rows(spark, results)
    assert {r["model"] for r in table.collect()} == {"linear_regression"} and table.count() == 8
    log = run_log(spark, results, "r1")
    kinds = {(r["model"], r["kind"], r["key"]) for r in log.collect()}
    assert ("random_forest", "status", "error") in kinds and ("linear_regression", "metric", "test_rmse") in kinds
    append_run_log(log, str(tmp_path / "log"))
    append_run_log(run_log(spark, results, "r2"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).select("run").distinct().count() == 2
    assert load_model(spark, str(tmp_path / "models/linear_regression/model")).name == "linear_regression"


def test_boosting_end_to_end_beats_the_mean(random_rows):
    result = train_and_evaluate(materialize(random_rows[0], "gbt-rows"), "gradient_boosting", {"n_estimators": 5, "learning_rate": 0.3})
    assert result["metrics"]["train"]["r2"] > 0.2


def test_history_does_not_depend_on_arrow_batches(spark, learnable):
    found = []
    for size in ("16", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found.append(MlpRegressor(hidden_dims=[8], epochs=2, batch_size=32, shards=3).fit(learnable).history)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [h["val_loss"] for h in found[0]] == pytest.approx([h["val_loss"] for h in found[1]], rel=1e-9)


def test_shards_follow_the_rows(spark):
    network = MlpRegressor(rows_per_shard=100)
    assert network._shards_for(spark.range(2050)) == 21 and network._shards_for(spark.range(5)) == 8


def test_cross_validation_covers_every_row(random_rows):
    rows = materialize(random_rows[0], "cv-rows")
    table = cross_validate(rows, "linear_regression", 3).collect()
    assert {r["fold"] for r in table} == {0, 1, 2} and sum(r["n"] for r in table) == rows.count()


def test_held_out_ratings_are_in_no_statistic(random_rows):
    """Shifting one fold's ratings leaves its predictions where they were."""
    rows = materialize(hash_folds(random_rows[0], 2), "fold-rows")
    moved = rows.withColumn("rating", F.when(F.col("fold") == 0, F.col("rating") + 100).otherwise(F.col("rating")))
    fits = [LinearRecipe().fit(x.filter("fold <> 0")) for x in (rows, moved)]
    a, b = (m.transform(rows.filter("fold = 0")).orderBy("row_id").collect() for m in fits)
    assert all(np.allclose(x["features"], y["features"]) for x, y in zip(a, b))


def test_stored_models_are_measured_on_their_split(spark, random_rows, tmp_path):
    rows = materialize(random_rows[0], "stored-rows")
    trained = run_models(rows, {"linear_regression": {}}, save_to=str(tmp_path))
    again = evaluate_stored(rows, str(tmp_path), ["linear_regression", "random_forest"])
    assert again["random_forest"] == {"error": "Model not found"}
    for side, values in trained["linear_regression"]["metrics"].items():
        assert again["linear_regression"]["metrics"][side]["rmse"] == pytest.approx(values["rmse"])
    assert again["linear_regression"]["train_samples"] + again["linear_regression"]["test_samples"] == rows.count()


@pytest.mark.parametrize("bad", [[[1.0, 2.0], [3.0, 4.0, 5.0, 6.0]], [[1.0], []]])
def test_arrays_of_different_lengths_raise(spark, bad):
    df = spark.createDataFrame([(x,) for x in bad], "features array<double>").coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        df.select(array_score(lambda m: m.sum(axis=1))("features")).collect()


def test_null_arrays_stay_null(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [3.0, 4.0]), (3, None)]
    df = spark.createDataFrame(rows, "i int, features array<double>").coalesce(1)
    summed = df.select("i", array_score(lambda m: m.sum(axis=1))("features").alias("s")).orderBy("i").collect()
    assert [r["s"] for r in summed] == [3.0, None, 7.0, None]
    doubled = df.select("i", array_map(lambda m: 2 * m)("features").alias("d")).orderBy("i").collect()
    assert [r["d"] for r in doubled] == [[2.0, 4.0], None, [6.0, 8.0], None]


def test_network_order_is_sparks_hash_order(spark):
    """The order within a shard equals the sort that each epoch ran over all rows; unknown keys included."""
    from stargauge.plans.mlp import mixed_order

    rng = np.random.default_rng(8)
    keys = [int(k) for k in rng.integers(-(2**63), 2**63 - 1, 300)] + [0, 1, -1, None]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "at int, row_id long")
    wanted = rows.orderBy(F.xxhash64(F.lit(42), F.lit(7), "row_id"), "row_id").collect()
    known = np.array([k is not None for k in keys])
    order = mixed_order(42, 7, np.array([k or 0 for k in keys], np.int64), known)
    assert order.tolist() == [r["at"] for r in wanted]


def test_network_epochs_sort_no_rows_in_spark(learnable, monkeypatch):
    """Rows are sorted and packed once; before, each epoch sorted the whole table again."""
    sorts, kind = [], type(learnable)
    plain = kind.sortWithinPartitions
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda self, *a, **k: sorts.append(a) or plain(self, *a, **k))
    counts = []
    for epochs in (1, 4):
        MlpRegressor(hidden_dims=[4], epochs=epochs, shards=2).fit(learnable)
        counts.append(len(sorts))
    assert counts[1] == 2 * counts[0] == 4


def test_network_keys_of_any_kind(learnable):
    network = MlpRegressor(hidden_dims=[4], epochs=2, shards=3, batch_size=32)
    named = learnable.withColumn("row_id", F.concat(F.lit("r"), "row_id"))
    model = network.fit(named, learnable)
    assert len(model.history) == 2 and np.isfinite(model.mean_squared_error(learnable))
