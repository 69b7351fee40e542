"""Regression metrics, model comparison and prediction summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import SIZE

MAPE_EPSILON = 1e-8
METRICS = ("rmse", "mae", "r2", "mape")
LOWER_IS_BETTER = ("rmse", "mae", "mape", "mse")
ZERO_METRIC = 1e-9
_HISTOGRAM_CELLS = 4096


def metric_columns(label: str = "rating", prediction: str = "prediction") -> dict[str, Column]:
    """RMSE, MAE, R2, MAPE (percent) and MSE as aggregates of one pass."""
    y, p = F.col(label), F.col(prediction)
    mse = F.avg((y - p) * (y - p))
    return {
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(y - p)),
        "r2": F.lit(1.0) - F.try_divide(mse, F.var_pop(y)),
        "mape": F.avg(F.abs(F.try_divide(y - p, y + F.lit(MAPE_EPSILON)))) * 100,
        "mse": mse,
    }


def regression_metrics(
    df: DataFrame,
    label: str = "rating",
    prediction: str = "prediction",
    by: list[str] | None = None,
) -> DataFrame:
    """One row of metrics (per group of ``by``), with the row count ``n``."""
    exprs = [c.alias(n) for n, c in metric_columns(label, prediction).items()]
    return df.groupBy(*(by or [])).agg(*exprs, F.count(F.lit(1)).alias("n"))


def long_metrics(wide: DataFrame, by: list[str]) -> DataFrame:
    """(model, split, ..., metric, value) rows from the wide form."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    return wide.select(*by, F.inline(F.array(*cells)))


def best_model(metrics: DataFrame) -> DataFrame:
    """Best model per metric from (model, position, metric, value) rows.

    Smallest value wins for errors, largest for R2; the first model in ``position`` wins a tie.
    NaN and null values do not compete.
    """
    usable = metrics.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    goal = F.when(F.col("metric").isin(*LOWER_IS_BETTER), F.col("value")).otherwise(-F.col("value"))
    return usable.groupBy("metric").agg(
        F.min_by("model", F.struct(goal, F.col("position"))).alias("best_model")
    )


def model_comparison(metrics: DataFrame) -> DataFrame:
    """One row per model with its metrics and a ``<metric>_best`` flag for each.

    Takes (model, position, metric, value) rows of the test side.
    """
    best = best_model(metrics)
    flagged = metrics.join(best, "metric", "left").withColumn(
        "is_best", F.coalesce(F.col("best_model") == F.col("model"), F.lit(False))
    )
    cells = []
    for m in METRICS:
        here = F.col("metric") == m
        cells.append(F.max(F.when(here & ~F.isnan("value"), F.col("value"))).alias(m))
        cells.append(F.coalesce(F.bool_or(here & F.col("is_best")), F.lit(False)).alias(f"{m}_best"))
    return flagged.groupBy("model", "position").agg(*cells)


def comparison_text(comparison: DataFrame) -> DataFrame:
    """Display form: four decimals (two for MAPE), N/A for missing, a star on the best."""
    shown = []
    for m in METRICS:
        digits = 2 if m == "mape" else 4
        number = F.coalesce(F.format_string(f"%.{digits}f", F.col(m)), F.lit("N/A"))
        number = F.when(F.col(m).isNull(), F.lit("N/A")).otherwise(number)
        shown.append(F.concat(F.when(F.col(f"{m}_best"), "*").otherwise(""), number).alias(m))
    return comparison.orderBy("position").select("model", *shown)


def overfit_ratio(metrics: DataFrame) -> DataFrame:
    """Relative change from train to test per model and metric: (test - train) / train.

    Null where the train value is zero up to rounding (the R2 of a constant prediction).
    """
    side = {s: F.max(F.when(F.col("split") == s, F.col("value"))) for s in ("train", "test")}
    return (
        metrics.groupBy("model", "metric")
        .agg(side["train"].alias("train_value"), side["test"].alias("test_value"))
        .withColumn(
            "degradation",
            F.when(
                F.abs("train_value") > ZERO_METRIC,
                (F.col("test_value") - F.col("train_value")) / F.col("train_value"),
            ),
        )
    )


def threshold_check(metrics: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """Compare metric rows with targets, each given as ('<' or '>', bound)."""
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(op).alias("relation"), F.lit(float(b)).alias("target"))
        for m, (op, b) in targets.items()
    ]
    goals = metrics.sparkSession.range(1).select(F.inline(F.array(*rows)))
    met = F.when(F.col("relation") == "<", F.col("value") < F.col("target")).otherwise(
        F.col("value") > F.col("target")
    )
    # One row per target, so the broadcast side has a known size.
    return metrics.join(F.broadcast(goals), "metric").withColumn("met", met)


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median (mean of the two middle values for an even count) without a global sort.

    Counts values in a histogram of fixed size, keeps only the cell holding the wanted rank, and
    repeats until one distinct value remains. Nulls and NaN are left out.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    n = values.count()
    if n == 0:
        return None
    low = _value_at_rank(values, (n - 1) // 2)
    return low if n % 2 else (low + _value_at_rank(values, n // 2)) / 2


def _value_at_rank(values: DataFrame, rank: int) -> float:
    """The value with ``rank`` smaller-or-earlier ones in sorted order (0-based)."""
    while True:
        span = values.agg(F.min("v").alias("a"), F.max("v").alias("b")).first()
        low, high = span["a"], span["b"]
        if low == high:
            return low
        width = (high - low) / _HISTOGRAM_CELLS
        cell = F.least(F.floor((F.col("v") - low) / width), F.lit(_HISTOGRAM_CELLS - 1)) if width > 0 else (
            F.when(F.col("v") > low, 1).otherwise(0)
        )
        histogram = sorted(
            (row["cell"], row["c"], row["a"], row["b"])
            for row in values.groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("a"), F.max("v").alias("b"))
            .collect()
        )
        for _, count, first, last in histogram:
            if rank < count:
                values = values.filter((F.col("v") >= first) & (F.col("v") <= last))
                break
            rank -= count


def prediction_summary(
    results: DataFrame,
    prediction: str = "predicted_rating",
    actual: str = "actual_rating",
    error: str = "error",
    exact: bool = True,
) -> DataFrame:
    """Summary row of a scored table; the actual and error figures only when those columns exist.

    The exact median reads ``results`` several times: pass a table at rest rather than a scoring plan. With
    ``exact=False`` it comes from a sketch in the same single pass, with the error that ``rank_error`` states.
    """
    exprs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg(prediction).alias("predicted_mean"),
        F.stddev_samp(prediction).alias("predicted_std"),
        F.min(prediction).alias("predicted_min"),
        F.max(prediction).alias("predicted_max"),
    ]
    if actual in results.columns:
        exprs += [
            F.avg(actual).alias("actual_mean"),
            F.stddev_samp(actual).alias("actual_std"),
            F.min(actual).alias("actual_min"),
            F.max(actual).alias("actual_max"),
            F.avg(error).alias("mean_absolute_error"),
            F.sqrt(F.avg(F.col(error) * F.col(error))).alias("rmse"),
        ]
    if not exact:
        value = F.col(prediction).cast("double")
        sketch = F.kll_sketch_agg_double(F.when(~F.isnan(value), value), SIZE)
        half = F.when(F.kll_sketch_get_n_double("_s") > 0, F.kll_sketch_get_quantile_double("_s", F.lit(0.5)))
        return results.agg(*exprs, sketch.alias("_s")).withColumn("predicted_median", half).drop("_s")
    median = exact_median(results, prediction)
    return results.agg(*exprs).withColumn("predicted_median", F.lit(median).cast("double"))


def head_predictions(results: DataFrame, n: int = 10, index: str = "original_index") -> DataFrame:
    """First ``n`` predictions in input order, display columns only."""
    shown = ["userId", "movieId", "predicted_rating", "actual_rating", "error", index]
    return results.orderBy(index).limit(n).select(*[c for c in shown if c in results.columns])


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)
