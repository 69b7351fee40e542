"""Forest recipe: key statistics, latent factors, genres, genre count and rating deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import genres as G
from ...functions import scores as S
from ...operators.attach import attach_factors
from ...operators.factors import svd_factors
from ...operators.stats import collect_vocabulary, movie_stats, user_stats
from ...session import materialize
from .base import Recipe, RecipeModel, as_doubles, register

USER_COLUMNS = ["user_avg_rating", "user_rating_count", "user_rating_std"]
MOVIE_COLUMNS = ["movie_avg_rating", "movie_rating_count", "movie_rating_std"]


class ForestRecipe(Recipe):
    """``include_target_deviation`` keeps the two deviations, which contain the target itself."""

    def __init__(
        self,
        n_svd_components: int = 20,
        random_state: int = 42,
        include_target_deviation: bool = True,
        n_iter: int = 5,
        vocabulary: list[str] | None = None,
    ):
        super().__init__()
        self.n_svd_components = n_svd_components
        self.random_state = random_state
        self.include_target_deviation = include_target_deviation
        self.n_iter = n_iter
        self.vocabulary = vocabulary

    def _fit(self, dataset: DataFrame) -> "ForestRecipeModel":
        self._check(dataset)
        k = self.n_svd_components
        factors = svd_factors(dataset, k, self.random_state, self.n_iter)
        # Factors ride along with the statistics: one join per key instead of two.
        user = user_stats(dataset, "user_rating_std").join(
            factors.user_factors.withColumnRenamed("factors", "user_factors"), "userId", "left"
        )
        movie = movie_stats(dataset, "movie_rating_std").join(
            factors.movie_factors.withColumnRenamed("factors", "movie_factors"), "movieId", "left"
        )
        vocabulary = collect_vocabulary(dataset) if self.vocabulary is None else self.vocabulary
        names = USER_COLUMNS + MOVIE_COLUMNS
        for i in range(k):
            names = names + [f"user_factor_{i}", f"movie_factor_{i}"]
        names = names + list(vocabulary) + ["num_genres"]
        if self.include_target_deviation:
            names = names + ["user_rating_deviation", "movie_rating_deviation"]
        return ForestRecipeModel(
            names,
            vocabulary,
            {"user": materialize(user, "forest-user"), "movie": materialize(movie, "forest-movie")},
            {
                "n_svd_components": k,
                "include_target_deviation": self.include_target_deviation,
                "singular_values": factors.singular_values,
            },
        )


@register
class ForestRecipeModel(RecipeModel):
    recipe = "random_forest"

    def prepare(self, dataset: DataFrame) -> DataFrame:
        k = self.state["n_svd_components"]
        joined = attach_factors(dataset, self.tables["user"], "userId", "user_factors", k)
        joined = attach_factors(joined, self.tables["movie"], "movieId", "movie_factors", k)
        zero = F.lit(0.0)
        stats = [F.coalesce(F.col(c), zero) for c in USER_COLUMNS + MOVIE_COLUMNS]
        factors = []
        for i in range(k):
            factors += [F.col("user_factors")[i], F.col("movie_factors")[i]]
        cells = stats + factors + [G.has_token("genres", g) for g in self.vocabulary]
        cells.append(G.num_genres("genres"))
        if self.state["include_target_deviation"]:
            cells += [S.deviation("user_avg_rating"), S.deviation("movie_avg_rating")]
        return joined.select(*dataset.columns, as_doubles(*cells).alias("features"))


def latent_factors(model: ForestRecipeModel, key: str) -> DataFrame:
    """The fitted (key, factors) table for 'userId' or 'movieId'."""
    side = {"userId": "user", "movieId": "movie"}[key]
    return model.tables[side].select(key, F.col(f"{side}_factors").alias("factors"))


def attach_latent_factors(df: DataFrame, model: ForestRecipeModel) -> DataFrame:
    """Both factor vectors on every row; zero vectors for unknown keys."""
    k = model.state["n_svd_components"]
    users = latent_factors(model, "userId").withColumnRenamed("factors", "user_factors")
    movies = latent_factors(model, "movieId").withColumnRenamed("factors", "movie_factors")
    joined = attach_factors(df, users, "userId", "user_factors", k)
    return attach_factors(joined, movies, "movieId", "movie_factors", k)
