"""Fit/transform contract of the feature recipes and their storage."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.scale import Moments
from ...session import materialize
from ...sources.readers import read_table
from ...sources.schemas import require_columns

PROCESSED_COLUMNS = ["userId", "movieId", "rating", "timestamp", "genres"]

RECIPES: dict[str, type["RecipeModel"]] = {}


def register(cls: type["RecipeModel"]) -> type["RecipeModel"]:
    """Make a fitted recipe loadable under its name."""
    RECIPES[cls.recipe] = cls
    return cls


class Recipe(Estimator):
    """Learns the per-user and per-movie tables of one feature recipe from processed ratings.

    The frame is read several times (one pass per statistics table), so pass a table at rest.
    """

    def _check(self, df: DataFrame, *more: str) -> None:
        require_columns(df, [*PROCESSED_COLUMNS, *more], "the processed table")


class RecipeModel(Model):
    """Fitted recipe: adds a ``features`` array, keeping every input column.

    ``tables`` are DataFrames at rest, keyed by user or movie; ``state`` is small JSON-like data.
    """

    recipe = ""

    def __init__(
        self,
        feature_columns: list[str],
        vocabulary: list[str],
        tables: dict[str, DataFrame],
        state: dict[str, Any] | None = None,
    ):
        super().__init__()
        self.feature_columns = feature_columns
        self.vocabulary = vocabulary
        self.tables = tables
        self.state = state or {}

    def prepare(self, dataset: DataFrame) -> DataFrame:
        """The joins and narrow features: the part worth storing when features are read often."""
        raise NotImplementedError

    def prepare_after(self, dataset: DataFrame, past: DataFrame | None = None) -> DataFrame:
        """:meth:`prepare` for rows that continue ``past`` rows, by default what was kept of the fitted ones."""
        return self.prepare(dataset)

    def continued(self, dataset: DataFrame) -> DataFrame:
        """:meth:`transform` for rows that come after the fitted ones, so that histories go on."""
        return self.finish(self.prepare_after(dataset))

    def finish(self, prepared: DataFrame) -> DataFrame:
        """Row-local widening of what :meth:`prepare` returned."""
        return prepared

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.finish(self.prepare(dataset))

    @property
    def moments(self) -> Moments:
        return Moments(**self.state["moments"])

    def save(self, path: str) -> None:
        """Tables as parquet, the rest as one JSON line; replaces what is at ``path``."""
        spark = next(iter(self.tables.values())).sparkSession
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/tables/{name}")
        meta = {
            "recipe": self.recipe,
            "feature_columns": self.feature_columns,
            "vocabulary": self.vocabulary,
            "tables": list(self.tables),
            "state": self.state,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")


def load_recipe(spark: SparkSession, path: str) -> RecipeModel:
    """A stored recipe; FileNotFoundError when there is none."""
    meta = load_json(spark, f"{path}/meta")
    tables = {name: read_table(spark, f"{path}/tables/{name}") for name in meta["tables"]}
    return RECIPES[meta["recipe"]](
        meta["feature_columns"], meta["vocabulary"], tables, meta["state"]
    )


def load_json(spark: SparkSession, path: str) -> dict:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    if row is None:
        raise FileNotFoundError(path)
    return json.loads(row["value"])


def keyed_table(df: DataFrame, key: str, label: str, **columns: Column) -> DataFrame:
    """One aggregation per key, written to the shared folder."""
    return materialize(df.groupBy(key).agg(*[c.alias(n) for n, c in columns.items()]), label)


def as_doubles(*columns: Column | str) -> Column:
    return F.array(
        *[(F.col(f"`{c}`") if isinstance(c, str) else c).cast("double") for c in columns]
    )


def weighted_mean(table: DataFrame, mean: str, count: str) -> float:
    """Overall mean from per-key means and counts, instead of another pass over the ratings."""
    row = table.agg(F.try_divide(F.sum(F.col(mean) * F.col(count)), F.sum(count)).alias("m")).first()
    return float(row["m"]) if row["m"] is not None else 0.0
