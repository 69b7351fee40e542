"""Cross-validation of least squares on leave-one-fold-out statistics, without refitting fold by fold.

Statistics are aggregated once per key and fold. What a model without fold f knows about a key is the merger of
the key's other folds, so one row per key holds the statistics of every such model. Rows meet these tables once;
one pass gathers the centred products of each model's features over the rows outside its fold, the driver
solves one small system per fold, and a last pass scores each row by the model that has not seen it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genres as G
from ..functions import timeparts as TP
from ..functions import vectors as V
from ..operators.attach import attach
from ..operators.metrics import regression_metrics
from ..operators.moments import State, co_deviations, least_squares, merged_states
from ..operators.split import hash_folds
from ..operators.stats import collect_vocabulary
from ..session import materialize

FEATURES = ("means", "recipe")


def fold_statistics(marked: DataFrame, key: str | None) -> DataFrame:
    """``key, parts``: count, mean and squared deviations of the ratings of each fold of a key."""
    keys = [key] if key else []
    n = F.count("rating")
    # Of no ratings the mean is null and the spread 0.
    cells = marked.groupBy(*keys, "fold").agg(
        n.alias("n"), F.avg("rating").alias("mean"), F.coalesce(F.var_pop("rating") * n, F.lit(0.0)).alias("spread")
    )
    return cells.groupBy(*keys).agg(F.collect_list(F.struct("fold", "n", "mean", "spread")).alias("parts"))


def merged_without(parts: Column, fold: int) -> Column:
    """(n, mean, spread) of all folds but one."""
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("spread"))

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        gap, share = b["mean"] - a["mean"], b["n"] / n
        return F.struct(
            n.alias("n"),
            (a["mean"] + gap * share).alias("mean"),
            (a["spread"] + b["spread"] + gap * gap * share * a["n"]).alias("spread"),
        )

    return F.aggregate(F.filter(parts, lambda p: (p["fold"] != fold) & (p["n"] > 0)), none, merge)


def leave_one_out(marked: DataFrame, key: str, folds: int, name: str, means: list[float]) -> DataFrame:
    """``key, <name>``: mean, sample deviation and count of the ratings outside each fold, fold by fold.

    A key without such ratings gets the fold's overall mean, no deviation and a count of one.
    """
    cells = []
    for fold in range(folds):
        rest = merged_without(F.col("parts"), fold)
        some = rest["n"] > 0
        deviation = F.when(rest["n"] > 1, F.sqrt(rest["spread"] / (rest["n"] - 1))).otherwise(0.0)
        cells += [
            F.when(some, rest["mean"]).otherwise(F.lit(means[fold])),
            F.when(some, deviation).otherwise(0.0),
            F.when(some, rest["n"]).otherwise(1).cast("double"),
        ]
    return fold_statistics(marked, key).select(key, F.array(*cells).alias(name))


def fold_means(marked: DataFrame, folds: int) -> list[float]:
    """Overall mean of the ratings outside each fold; 0 without any."""
    row = fold_statistics(marked, None).select(*[merged_without(F.col("parts"), f)["mean"] for f in range(folds)]).first()
    return [float(v) for v in row]


def features_without(fold: int, user: np.ndarray, movie: np.ndarray, own: np.ndarray, features: str) -> np.ndarray:
    """The feature rows of the model that leaves ``fold`` out."""
    at = slice(3 * fold, 3 * fold + 3)
    if features == "means":
        return np.column_stack([user[:, at.start], movie[:, at.start]])
    both = user[:, at.start] * movie[:, at.start]
    return V.expand_pairs(np.column_stack([user[:, at], movie[:, at], own, both]))


def fold_rows(processed: DataFrame, folds: int, seed: int, keys: list[str] | None, features: str) -> DataFrame:
    """Every rated row with its fold and the statistics of all models, stored."""
    marked = hash_folds(processed, folds, seed, keys).filter(F.col("rating").isNotNull())
    marked = materialize(marked, "folds")
    means = fold_means(marked, folds)
    users = materialize(leave_one_out(marked, "userId", folds, "_user", means), "fold-users")
    movies = materialize(leave_one_out(marked, "movieId", folds, "_movie", means), "fold-movies")
    own: list[Column] = []
    if features == "recipe":
        own = [G.has_token("genres", g).cast("double") for g in collect_vocabulary(marked)]
        own += [F.coalesce(part("timestamp").cast("double"), F.lit(0.0)) for part in (TP.hour, TP.weekday)]
    joined = attach(attach(marked, users, "userId"), movies, "movieId")
    # A null key matches nothing; it is unseen by every model.
    unseen = F.array(*[F.lit(v) for mean in means for v in (mean, 0.0, 1.0)])
    return materialize(
        joined.select(
            "fold",
            "rating",
            F.coalesce("_user", unseen).alias("user"),
            F.coalesce("_movie", unseen).alias("movie"),
            F.array(*own).cast("array<double>").alias("own"),
        ),
        "fold-rows",
    )


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    fold, rating = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
    wide = [V.to_matrix(batch.column(i)) for i in range(2, 5)]
    return fold, rating, *wide


def cross_validate_least_squares(
    processed: DataFrame,
    folds: int = 5,
    seed: int = 42,
    keys: list[str] | None = None,
    features: str = "recipe",
) -> DataFrame:
    """Metrics per held-out fold of least squares whose statistics and weights come from the other folds.

    ``features`` is 'means' (user mean, movie mean) or 'recipe' (the linear recipe's features and all their
    pairwise products). Folds come from the key hash; rows without a rating take no part.
    """
    if features not in FEATURES:
        raise ValueError(f"features must be one of {FEATURES}, not {features!r}")
    if folds < 2:
        raise ValueError("at least two folds are needed")
    rows = fold_rows(processed, folds, seed, keys, features)

    def local(batch: pa.RecordBatch) -> Iterator[tuple[int, State]]:
        fold, rating, user, movie, own = _matrices(batch)
        for f in range(folds):
            x = features_without(f, user, movie, own, features)[fold != f]
            if len(x):
                yield f, co_deviations(np.column_stack([x, rating[fold != f]]))

    models = {f: least_squares(state) for f, state in merged_states(rows, local).items()}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, rating, user, movie, own = _matrices(batch)
            found = np.full(len(fold), np.nan)
            for f, (weights, intercept) in models.items():
                mine = fold == f
                if mine.any():
                    found[mine] = features_without(f, user[mine], movie[mine], own[mine], features) @ weights + intercept
            cells = [batch.column(0), batch.column(1), pa.array(found)]
            yield pa.RecordBatch.from_arrays(cells, names=["fold", "rating", "prediction"])

    predictions = rows.mapInArrow(scored, "fold int, rating double, prediction double")
    return regression_metrics(predictions, by=["fold"])
