"""Linear recipe: the shared features, all pairwise products, standard-scaled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.vectors import pair_names
from ...operators.scale import array_moments, scaled_interactions
from ...operators.stats import collect_vocabulary
from ...session import materialize
from . import mean_features as MF
from .base import Recipe, RecipeModel, register, weighted_mean


class LinearRecipe(Recipe):
    """``stats_scope='fit'`` reuses the fitted statistics; ``'input'`` recomputes them per frame."""

    def __init__(self, stats_scope: str = "fit", vocabulary: list[str] | None = None):
        super().__init__()
        if stats_scope not in ("fit", "input"):
            raise ValueError(f"stats_scope must be 'fit' or 'input', not {stats_scope!r}")
        self.stats_scope = stats_scope
        self.vocabulary = vocabulary

    def _fit(self, dataset: DataFrame) -> "LinearRecipeModel":
        self._check(dataset)
        tables = {
            name: materialize(table, f"linear-{name}")
            for name, table in MF.stat_tables(dataset).items()
        }
        vocabulary = collect_vocabulary(dataset) if self.vocabulary is None else self.vocabulary
        mean = weighted_mean(tables["user"], "user_avg_rating", "user_rating_count")
        # The scaler makes two passes over the base features; they are narrow, so write them once.
        base = materialize(_base_features(dataset, tables, mean, vocabulary).select("features"), "linear-base")
        moments = array_moments(base, "features", expand=True)
        return LinearRecipeModel(
            pair_names(MF.column_names(vocabulary)),
            vocabulary,
            tables,
            {"global_mean": mean, "moments": moments.to_dict(), "stats_scope": self.stats_scope},
        )


def _base_features(df, tables, mean, vocabulary):
    joined = MF.attach_stats(df, tables, mean)
    # A missing time or rating counts as 0, so that one such row cannot spoil a column's moments.
    known = [F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0)) for c in MF.expressions(vocabulary)]
    return joined.select(*df.columns, F.array(*known).alias("features"))


@register
class LinearRecipeModel(RecipeModel):
    recipe = "linear_regression"

    def prepare(self, dataset: DataFrame) -> DataFrame:
        from_input = self.state["stats_scope"] == "input"
        tables = MF.stat_tables(dataset) if from_input else self.tables
        return _base_features(dataset, tables, self.state["global_mean"], self.vocabulary)

    def finish(self, prepared: DataFrame) -> DataFrame:
        return scaled_interactions(prepared, "features", self.moments)
