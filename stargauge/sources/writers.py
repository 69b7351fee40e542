"""Sinks: processed tables, feature tables, predictions, metrics and the run log."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import CSV_QUOTING, read_table
from .schemas import ROW_ID

DEFAULT_PREDICTIONS_PATH = "predictions/mlp_predictions.csv"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path`` (parquet by default, headed CSV the readers here understand on request)."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, **CSV_QUOTING)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_predictions(results: DataFrame, path: str | None = None, fmt: str = "csv") -> str:
    """Write scored rows, by default to the usual predictions path; returns the path used."""
    target = path or DEFAULT_PREDICTIONS_PATH
    write_table(results, target, fmt)
    return target


def write_feature_table(features: DataFrame, feature_columns: list[str] | None, path: str) -> None:
    """Feature array + rating per row, with the ordered column names kept in the field metadata.

    Without names the columns are called ``f0..fn``.
    """
    if feature_columns is None:
        width = features.select(F.size("features").alias("n")).first()
        feature_columns = [f"f{i}" for i in range(width["n"] if width else 0)]
    keep = [c for c in (ROW_ID, "userId", "movieId") if c in features.columns]
    labelled = F.col("features").alias("features", metadata={"feature_columns": feature_columns})
    write_table(features.select(*keep, labelled, "rating"), path)


def read_feature_table(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The feature table and its ordered feature names."""
    table = read_table(spark, path)
    return table, list(table.schema["features"].metadata.get("feature_columns", []))


def feature_names_flat(table: DataFrame, feature_columns: list[str]) -> DataFrame:
    """Flatten the feature array into one column per feature plus ``rating``."""
    folded = [name.lower() for name in feature_columns]
    if len(set(folded)) != len(folded):
        raise ValueError("feature names must differ by more than letter case")
    flat = [F.col("features")[i].alias(name) for i, name in enumerate(feature_columns)]
    return table.select(*flat, "rating")


def write_runs(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rows of runs (column ``run``): a run that is there already is replaced, others stay."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run")
    writer.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines; rows with a ``run`` replace those of the same run, others everything."""
    if "run" in metrics.columns:
        write_runs(metrics, path, "json")
    else:
        metrics.write.mode("overwrite").json(path)


def plain_values(value: Any) -> Any:
    """Coerce a nested metrics structure to JSON types; anything unknown becomes text."""
    if isinstance(value, dict):
        return {str(k): plain_values(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain_values(v) for v in value]
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if hasattr(value, "tolist"):
        return plain_values(value.tolist())
    return str(value)


def metrics_to_json(metrics: dict) -> str:
    """Small driver-side metrics structure as JSON text."""
    return json.dumps(plain_values(metrics), indent=2)
