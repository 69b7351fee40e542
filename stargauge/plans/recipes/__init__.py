"""The four feature recipes, by model name."""

from .base import Recipe, RecipeModel, load_recipe
from .boosting import BoostingRecipe, BoostingRecipeModel
from .forest import ForestRecipe, ForestRecipeModel
from .linear import LinearRecipe, LinearRecipeModel
from .means import MeansRecipe, MeansRecipeModel
from .mlp import MlpRecipe, MlpRecipeModel
from .sparse import SparseRecipe, SparseRecipeModel

RECIPE_BY_MODEL: dict[str, type[Recipe]] = {
    "linear_regression": LinearRecipe,
    "random_forest": ForestRecipe,
    "gradient_boosting": BoostingRecipe,
    "multi_layer_perceptron": MlpRecipe,
}

__all__ = [
    "RECIPE_BY_MODEL",
    "BoostingRecipe",
    "BoostingRecipeModel",
    "ForestRecipe",
    "ForestRecipeModel",
    "LinearRecipe",
    "LinearRecipeModel",
    "MeansRecipe",
    "MeansRecipeModel",
    "MlpRecipe",
    "MlpRecipeModel",
    "Recipe",
    "RecipeModel",
    "SparseRecipe",
    "SparseRecipeModel",
    "load_recipe",
]
