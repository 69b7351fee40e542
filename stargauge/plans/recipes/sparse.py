"""Recipe for genre vocabularies of any size: scaled key statistics and time, genres as sparse entries."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ...operators.scale import column_moments, scaled_columns
from ...operators.vocabulary import add_genre_places, vocabulary_table
from ...session import materialize
from . import mean_features as MF
from .base import Recipe, RecipeModel, register, weighted_mean

DENSE_COLUMNS = MF.column_names([])


class SparseRecipe(Recipe):
    """The neural recipe's features with genres as sparse entries, for regressors that take sparse vectors.

    A genre's entry is divided by the deviation of its column like every other feature; only the shift by the mean,
    which would fill the vector, is left to the regressor's intercept.
    """

    def _fit(self, dataset: DataFrame) -> "SparseRecipeModel":
        self._check(dataset)
        tables = {name: materialize(t, f"sparse-{name}") for name, t in MF.stat_tables(dataset).items()}
        mean = weighted_mean(tables["user"], "user_avg_rating", "user_rating_count")
        moments = column_moments(MF.attach_stats(dataset, tables, mean), MF.expressions([]))
        share = F.col("n") / F.lit(moments.count)
        weight = F.when(share < 1, 1 / F.sqrt(share * (1 - share))).otherwise(1.0)
        tables["vocabulary"] = materialize(
            vocabulary_table(dataset).select("genre", "place", weight.alias("weight")), "sparse-vocabulary"
        )
        state = {"global_mean": mean, "moments": moments.to_dict(), "genres": tables["vocabulary"].count()}
        return SparseRecipeModel(DENSE_COLUMNS, [], tables, state)


@register
class SparseRecipeModel(RecipeModel):
    """``feature_columns`` names the dense features; the genres follow in the order of the vocabulary table."""

    recipe = "sparse_linear"

    @property
    def width(self) -> int:
        return len(DENSE_COLUMNS) + self.state["genres"]

    def prepare(self, dataset: DataFrame) -> DataFrame:
        """``features`` as the parts of a sparse vector: type, size, indices and values."""
        joined = MF.attach_stats(dataset, self.tables, self.state["global_mean"])
        joined = add_genre_places(joined, self.tables["vocabulary"], "weight")
        dense = [F.coalesce(c, F.lit(0.0)) for c in scaled_columns(MF.expressions([]), self.moments)]
        first = F.array(*[F.lit(i) for i in range(len(DENSE_COLUMNS))])
        shifted = F.transform("places", lambda p: p + len(DENSE_COLUMNS))
        parts = F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(self.width).alias("size"),
            F.concat(first, shifted).alias("indices"),
            F.concat(F.array(*dense), "weights").alias("values"),
        )
        return joined.select(*dataset.columns, parts.alias("features"))

    def finish(self, prepared: DataFrame) -> DataFrame:
        """The same rows with the parts read as vectors.

        A stored vector is a struct of these parts, so the rows are written once and read back as vectors.
        """
        fields = [f if f.name != "features" else StructField("features", VectorUDT()) for f in prepared.schema.fields]
        return materialize(prepared, "sparse-features", StructType(fields))
