"""Feature, training and evaluation jobs over one processed table."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.metrics import METRICS, regression_metrics
from ..operators.split import hash_folds, train_test
from ..session import materialize
from ..sources.readers import read_table
from ..sources.schemas import ROW_ID
from ..sources.writers import write_runs
from .estimators import create_model, load_model, save_model
from .recipes import RECIPE_BY_MODEL, load_recipe

RUN_LOG = "run string, model string, kind string, key string, value double, text string"


def build_features(
    processed: DataFrame,
    model_name: str,
    test_size: float = 0.2,
    seed: int = 42,
    fit_scope: str = "train",
    keys: list[str] | None = None,
    carry_history: bool = False,
    **recipe_params: Any,
):
    """(recipe model, train features, test features).

    ``fit_scope='train'`` fits the recipe on the training side only and prepares each side by itself,
    so histories (rolling means) start anew on the test side, unless ``carry_history`` lets the training
    rows take part in them. ``'all'`` fits on every row, prepares the whole table once and then splits it.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError(f"fit_scope must be 'train' or 'all', not {fit_scope!r}")
    recipe = RECIPE_BY_MODEL[model_name](**recipe_params)
    keys_and_target = (ROW_ID, "userId", "movieId", "rating", *(keys or []))
    keep = [c for c in dict.fromkeys(keys_and_target) if c in processed.columns] + ["features"]
    if fit_scope == "all":
        fitted = recipe.fit(processed)
        whole = materialize(fitted.prepare(processed).select(*keep), f"{model_name}-features")
        return fitted, *(fitted.finish(side) for side in train_test(whole, test_size, seed, keys))
    train, test = train_test(processed, test_size, seed, keys)
    fitted = recipe.fit(train)

    def features(prepared: DataFrame, label: str) -> DataFrame:
        return fitted.finish(materialize(prepared.select(*keep), f"{model_name}-{label}"))

    after = fitted.prepare_after(test, train) if carry_history else fitted.prepare(test)
    return fitted, features(fitted.prepare(train), "train"), features(after, "test")


def train_and_evaluate(
    processed: DataFrame,
    model_name: str,
    model_params: dict[str, Any] | None = None,
    recipe_params: dict[str, Any] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    save_to: str | None = None,
) -> dict[str, Any]:
    """Fit recipe and model on the training side, measure both sides."""
    recipe, train, test = build_features(
        processed, model_name, test_size, seed, **(recipe_params or {})
    )
    model = create_model(model_name, **(model_params or {})).fit(train)
    spark = processed.sparkSession
    if save_to:
        recipe.save(f"{save_to}/{model_name}/recipe")
        save_model(spark, model, f"{save_to}/{model_name}/model")
    return {
        "recipe": recipe,
        "model": model,
        "metrics": measured(model, train, test),
        "params": model_params or {},
        "features": len(recipe.feature_columns),
    }


def measured(model: Any, train: DataFrame, test: DataFrame) -> dict[str, dict[str, Any]]:
    """Metrics of both sides of a split, from one pass over each."""
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    rows = regression_metrics(model.transform(both), by=["split"]).collect()
    return {row["split"]: {m: row[m] for m in (*METRICS, "mse", "n")} for row in rows}


def evaluate_stored(
    processed: DataFrame,
    folder: str,
    model_names: list[str],
    test_size: float = 0.2,
    seed: int = 42,
    keys: list[str] | None = None,
) -> dict[str, dict[str, Any]]:
    """Measure stored models on the split they were trained with, all of them in one read of each side.

    Each name is loaded from ``folder/<name>/{recipe,model}``; a missing one is recorded as
    ``{"error": "Model not found"}``, any other failure by its message, and the rest go on.
    """
    spark = processed.sparkSession
    loaded: dict[str, tuple] = {}
    errors: dict[str, str] = {}
    for name in model_names:
        try:
            recipe = load_recipe(spark, f"{folder}/{name}/recipe")
            loaded[name] = recipe, load_model(spark, f"{folder}/{name}/model")
        except FileNotFoundError:
            errors[name] = "Model not found"
    sides = dict(zip(("train", "test"), train_test(processed, test_size, seed, keys)))
    try:
        found = _measured_together(sides, loaded)
    except Exception:
        # One of them fails: the others are measured without it.
        found = {}
        for name, pair in loaded.items():
            try:
                found |= _measured_together(sides, {name: pair})
            except Exception as error:
                errors[name] = f"{type(error).__name__}: {error}"
    results: dict[str, dict[str, Any]] = {}
    for name in model_names:
        if name in errors:
            results[name] = {"error": errors[name]}
            continue
        metrics = found[name]
        samples = {f"{side}_samples": values["n"] for side, values in metrics.items()}
        results[name] = {"metrics": metrics, "features": len(loaded[name][0].feature_columns), **samples}
    return results


def _measured_together(sides: dict[str, DataFrame], loaded: dict[str, tuple]) -> dict[str, dict[str, Any]]:
    """Metrics of all models on all sides, each side read once: predictions become columns, then rows."""
    if not loaded:
        return {}
    scored = None
    for side, rows in sides.items():
        for i, (recipe, model) in enumerate(loaded.values()):
            kept = [F.col(f"`{c}`") for c in rows.columns]
            predicted = model.transform(recipe.transform(rows))
            rows = predicted.select(*kept, F.col("prediction").alias(f"_prediction_{i}"))
        cells = [
            F.struct(F.lit(name).alias("model"), F.col(f"_prediction_{i}").alias("prediction"))
            for i, name in enumerate(loaded)
        ]
        part = rows.select(F.lit(side).alias("split"), "rating", F.inline(F.array(*cells)))
        scored = part if scored is None else scored.unionByName(part)
    found: dict[str, dict[str, Any]] = {name: {} for name in loaded}
    for row in regression_metrics(scored, by=["model", "split"]).collect():
        found[row["model"]][row["split"]] = {m: row[m] for m in (*METRICS, "mse", "n")}
    return found


def run_models(
    processed: DataFrame, jobs: dict[str, dict[str, Any]], **shared: Any
) -> dict[str, dict[str, Any]]:
    """Train several models; one model's failure is recorded as ``error`` and the rest go on.

    ``jobs`` maps a model name to keyword arguments of :func:`train_and_evaluate`.
    """
    results = {}
    for name, arguments in jobs.items():
        try:
            results[name] = train_and_evaluate(processed, name, **(shared | arguments))
        except Exception as error:
            results[name] = {"error": f"{type(error).__name__}: {error}"}
    return results


def metric_rows(spark: SparkSession, results: dict[str, dict[str, Any]]) -> DataFrame:
    """(model, position, split, metric, value) rows; failed models have none."""
    rows = [
        (name, position, side, metric, float(values[metric]))
        for position, (name, result) in enumerate(results.items())
        for side, values in result.get("metrics", {}).items()
        for metric in METRICS
        if values[metric] is not None
    ]
    return spark.createDataFrame(
        rows, "model string, position int, split string, metric string, value double"
    )


def run_log(
    spark: SparkSession, results: dict[str, dict[str, Any]], run: str | None = None
) -> DataFrame:
    """Parameters, sizes, metrics and failures of a run as rows, ready to append to a log table.

    Numbers go to ``value``; everything else, lists included, to ``text``.
    """
    run = run or uuid.uuid4().hex
    rows: list[tuple] = []
    for name, result in results.items():
        if "error" in result:
            rows.append((run, name, "status", "error", None, result["error"]))
            continue
        rows.append((run, name, "status", "ok", None, None))
        for key, value in result.get("params", {}).items():
            number = isinstance(value, (int, float)) and not isinstance(value, bool)
            rows.append(
                (run, name, "param", key, float(value) if number else None, None if number else str(value))
            )
        if "features" in result:
            rows.append((run, name, "param", "features", float(result["features"]), None))
        for side, values in result.get("metrics", {}).items():
            for key, value in values.items():
                number = None if value is None else float(value)
                rows.append((run, name, "metric", f"{side}_{key}", number, None))
    return spark.createDataFrame(rows, RUN_LOG)


def append_run_log(log: DataFrame, path: str) -> None:
    """Add runs to the log; a run written again replaces its rows, so a repeated job leaves no doubles."""
    write_runs(log, path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, StructType.fromDDL(RUN_LOG))


def cross_validate(
    processed: DataFrame,
    model_name: str,
    folds: int = 5,
    seed: int = 42,
    keys: list[str] | None = None,
    recipe_params: dict[str, Any] | None = None,
    **params: Any,
) -> DataFrame:
    """Metrics per held-out fold; folds come from the key hash. ``processed`` should be at rest.

    Recipe and model are fitted on the other folds, so a held-out rating is in none of its features.
    """
    marked = hash_folds(processed, folds, seed, keys)
    scored = None
    for fold in range(folds):
        rest = marked.filter(F.col("fold") != fold)
        recipe = RECIPE_BY_MODEL[model_name](**(recipe_params or {})).fit(rest)
        model = create_model(model_name, **params).fit(recipe.transform(rest))
        held_out = recipe.transform(marked.filter(F.col("fold") == fold))
        part = model.transform(held_out).select("fold", "rating", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return regression_metrics(scored, by=["fold"])
