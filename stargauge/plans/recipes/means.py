"""Smallest recipe: the mean rating of the user, of the movie, or of both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators.attach import attach, fill_defaults
from ...session import materialize
from .base import Recipe, RecipeModel, as_doubles, register

NAMES = {"userId": "user_avg_rating", "movieId": "movie_avg_rating"}


class MeansRecipe(Recipe):
    """``keys`` names the means; unknown keys get the overall mean of the fitted rows."""

    def __init__(self, keys: tuple[str, ...] = ("userId", "movieId")):
        super().__init__()
        if not keys or set(keys) - set(NAMES):
            raise ValueError(f"keys must be some of {list(NAMES)}, not {list(keys)}")
        self.keys = list(keys)

    def _fit(self, dataset: DataFrame) -> "MeansRecipeModel":
        self._check(dataset)
        tables = {
            key: materialize(dataset.groupBy(key).agg(F.avg("rating").alias(NAMES[key])), f"means-{key}")
            for key in self.keys
        }
        mean = dataset.agg(F.avg("rating").alias("m")).first()["m"]
        state = {"keys": self.keys, "global_mean": 0.0 if mean is None else mean}
        return MeansRecipeModel([NAMES[k] for k in self.keys], [], tables, state)


@register
class MeansRecipeModel(RecipeModel):
    recipe = "means"

    def prepare(self, dataset: DataFrame) -> DataFrame:
        joined = dataset
        for key in self.state["keys"]:
            joined = attach(joined, self.tables[key], key)
        joined = fill_defaults(joined, dict.fromkeys(self.feature_columns, self.state["global_mean"]))
        return joined.select(*dataset.columns, as_doubles(*self.feature_columns).alias("features"))
