"""Truncated SVD of the sparse user x movie matrix by products of its tiles.

Randomized subspace iteration (Halko, Martinsson, Tropp 2011). The cells are cut once into (user block,
movie block) tiles that stay where they are; a basis is one dense block per block of users or movies. A product
sends basis blocks to the tiles, multiplies there in numpy, and adds up the blocks of the other side in a
tree, so what moves grows with users and movies and not with ratings. The driver sees only width x width
matrices, where width is the number of factors plus a small surplus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import colocated, materialize
from .stats import user_item_mean

# A direction this much weaker than the strongest one (in squared length) is rounding noise.
_RANK_TOLERANCE = 1e-13
#: Users or movies of one block, cells of one tile, and blocks that one task adds up.
BLOCK_KEYS = 1 << 16
TILE_CELLS = 1 << 18
FAN_IN = 16


@dataclass(frozen=True)
class SvdFactors:
    """``user_factors`` holds U x Sigma rows, ``movie_factors`` rows of V."""

    user_factors: DataFrame
    movie_factors: DataFrame
    singular_values: list[float]


@dataclass(frozen=True)
class Side:
    """The keys of one side, ``key, block, at``: each key's block and its place there."""

    key: str
    index: DataFrame
    keys: int
    blocks: int


@dataclass(frozen=True)
class Tiles:
    """``user_block, movie_block, cells``: cells are (place of the user, place of the movie, value)."""

    rows: DataFrame
    users: Side
    movies: Side


def svd_factors(
    ratings: DataFrame,
    n_components: int = 20,
    seed: int = 42,
    n_iter: int = 5,
    oversample: int = 10,
) -> SvdFactors:
    """Leading factors of the user x movie matrix of mean ratings (missing = 0, not centred).

    Signs are fixed so that the largest entry of every movie factor is positive. Fewer independent
    directions than ``n_components`` leave zero columns. More components than movies: ValueError. Rows without
    a user or a movie are left out; a mean of no ratings is 0.
    """
    known = ratings.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull())
    cells = materialize(user_item_mean(known).na.fill(0.0, subset=["rating"]), "svd-cells")
    tiles = cut_tiles(cells, n_components)
    width = min(n_components + oversample, tiles.movies.keys)
    movie_basis = _random_basis(tiles.movies, width, seed)
    for step in range(n_iter + 1):
        user_basis = materialize(_product(tiles, movie_basis, width, to_users=True), "svd-users")
        user_basis, width = _rotated(user_basis, width, _whitening(_gram(user_basis, width)))
        movie_side = materialize(_product(tiles, user_basis, width, to_users=False), "svd-movies")
        if step < n_iter:
            movie_basis, width = _rotated(movie_side, width, _whitening(_gram(movie_side, width)))
    strengths, rotation = _spectrum(_gram(movie_side, width))
    keep = min(n_components, int((strengths > strengths[0] * _RANK_TOLERANCE).sum()))
    sigma = np.sqrt(strengths[:keep])
    rotation = rotation[:, :keep]
    movie_factors, _ = _rotated(movie_side, width, rotation / sigma)
    signs = _signs(movie_factors, keep)
    pad = n_components - keep
    to_movie = np.hstack([rotation / sigma * signs, np.zeros((width, pad))])
    to_user = np.hstack([rotation * sigma * signs, np.zeros((width, pad))])
    return SvdFactors(
        _keyed(_rotated(user_basis, width, to_user)[0], tiles.users, n_components),
        _keyed(_rotated(movie_side, width, to_movie)[0], tiles.movies, n_components),
        sigma.tolist() + [0.0] * pad,
    )


def _side(cells: DataFrame, key: str, least: int, per_block: int) -> Side:
    keys = materialize(cells.select(key).distinct(), f"svd-{key}")
    n = keys.count()
    if n < least:
        raise ValueError(f"n_components={least} exceeds the number of movies ({n})")
    blocks = -(-n // per_block) or 1
    numbered = keys.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    place = F.row_number().over(Window.partitionBy("block").orderBy(key)) - 1
    return Side(key, materialize(numbered.withColumn("at", place), f"svd-{key}"), n, blocks)


def cut_tiles(cells: DataFrame, n_components: int = 0) -> Tiles:
    """Cells (userId, movieId, rating) as tiles of about ``TILE_CELLS``, dealt by block pair once."""
    movies = _side(cells, "movieId", n_components, BLOCK_KEYS)
    # Users fall into so many blocks that the tiles of a movie block are small, too.
    n_cells = cells.count()
    n_users = cells.select("userId").distinct().count()
    user_blocks = max(-(-n_users // BLOCK_KEYS), n_cells // (TILE_CELLS * movies.blocks), 1)
    users = _side(cells, "userId", 0, -(-n_users // user_blocks) or 1)
    placed = cells
    for side, name in ((users, "user"), (movies, "movie")):
        index = side.index.select(side.key, F.col("block").alias(f"{name}_block"), F.col("at").alias(f"{name}_at"))
        placed = placed.join(index, side.key)
    keys = ["user_block", "movie_block"]
    cell = F.struct("user_at", "movie_at", "rating")
    tiles = placed.select(*keys, cell.alias("cell")).groupBy(*keys).agg(F.collect_list("cell").alias("cells"))
    return Tiles(colocated(tiles, keys, users.blocks * movies.blocks), users, movies)


def _random_basis(side: Side, width: int, seed: int) -> DataFrame:
    """``block, q``: rows of uniform numbers drawn by hashing each key."""
    draws = [f"cast(xxhash64({side.key}, {j}, {seed}) as double) / 9.223372036854775808e18D" for j in range(width)]
    rows = side.index.select("block", F.struct("at", F.expr(f"array({', '.join(draws)}) AS q")).alias("row"))
    ordered = F.sort_array(F.collect_list("row"))
    return rows.groupBy("block").agg(F.flatten(F.transform(ordered, lambda r: r["q"])).alias("q"))


def _product(tiles: Tiles, basis: DataFrame, width: int, to_users: bool) -> DataFrame:
    """Matrix x movie basis, or its transpose x user basis, as ``block, q``."""
    here, there = (tiles.users, tiles.movies) if to_users else (tiles.movies, tiles.users)
    own, other = ("user_block", "movie_block") if to_users else ("movie_block", "user_block")
    sent = basis.select(
        F.col("block").alias(other), "q", F.explode(F.sequence(F.lit(0), F.lit(here.blocks - 1))).alias(own)
    )
    met = tiles.rows.join(sent, ["user_block", "movie_block"]).select(own, other, "cells", "q")
    at, source = (0, 1) if to_users else (1, 0)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cells = batch.column(2).slice(i, 1).flatten()
                to, of, value = (cells.field(k).to_numpy(zero_copy_only=False) for k in (at, source, 2))
                q = batch.column(3).slice(i, 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                size = int(to.max()) + 1
                block = np.column_stack([np.bincount(to, value * q[of, j], size) for j in range(width)])
                cells = [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), V.to_lists(block.reshape(1, -1))]
                yield pa.RecordBatch.from_arrays(cells, names=["block", "part", "q"])

    partial = met.mapInArrow(multiplied, "block int, part int, q array<double>")
    parts = there.blocks
    while parts > 1:
        partial = _added(partial.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")))
        parts = -(-parts // FAN_IN)
    return partial.select("block", "q")


def _added(partial: DataFrame) -> DataFrame:
    """Sums of the blocks (of several lengths: missing rows are 0) of each (block, part)."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, np.zeros(0)

        def done() -> pa.RecordBatch:
            cells = [pa.array([held[0]], pa.int32()), pa.array([held[1]], pa.int32()), V.to_lists(total.reshape(1, -1))]
            return pa.RecordBatch.from_arrays(cells, names=["block", "part", "q"])

        for batch in batches:
            for i in range(batch.num_rows):
                name = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                q = batch.column(2).slice(i, 1).flatten().to_numpy(zero_copy_only=False)
                if name != held:
                    if held is not None:
                        yield done()
                    held, total = name, np.zeros(0)
                if len(q) > len(total):
                    total = np.concatenate([total, np.zeros(len(q) - len(total))])
                total[: len(q)] += q
        if held is not None:
            yield done()

    dealt = partial.repartition("block", "part").sortWithinPartitions("block", "part")
    return dealt.mapInArrow(added, partial.schema)


def _gram(basis: DataFrame, width: int) -> np.ndarray:
    def rows(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    return V.summed_over_rows(basis, "q", lambda x: (x.T @ x).ravel(), rows).reshape(width, width)


def _spectrum(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(gram)
    return values[::-1], vectors[:, ::-1]


def _whitening(gram: np.ndarray) -> np.ndarray:
    """Right factor that makes a basis orthonormal; dependent directions are left out."""
    values, vectors = _spectrum(gram)
    keep = values > values[0] * _RANK_TOLERANCE
    return vectors[:, keep] / np.sqrt(values[keep])


def _each_block(function) -> Column:
    """Column ``q`` with ``function`` of each block's flat numbers."""

    @F.arrow_udf("array<double>")
    def apply(column: pa.Array) -> pa.Array:
        blocks = [column.slice(i, 1).flatten().to_numpy(zero_copy_only=False) for i in range(len(column))]
        return pa.array([function(b) for b in blocks], pa.list_(pa.float64()))

    return apply("q")


def _rotated(basis: DataFrame, width: int, matrix: np.ndarray) -> tuple[DataFrame, int]:
    turned = _each_block(lambda b: (b.reshape(-1, width) @ matrix).ravel())
    return basis.withColumn("q", turned), matrix.shape[1]


def _signs(factors: DataFrame, width: int) -> np.ndarray:
    """Sign of the entry with the largest absolute value per column; positive on a tie."""

    def extremes(block: np.ndarray) -> np.ndarray:
        rows = block.reshape(-1, width)
        return np.concatenate([rows.max(axis=0), -rows.min(axis=0)])

    ends = factors.select(F.posexplode(_each_block(extremes)).alias("pos", "v")).groupBy("pos").agg(F.max("v").alias("v"))
    values = {r["pos"]: r["v"] for r in ends.collect()}
    return np.array([1.0 if values[j] >= values[width + j] else -1.0 for j in range(width)])


def _keyed(basis: DataFrame, side: Side, width: int) -> DataFrame:
    """``key, factors``: one row per key of a basis."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q = batch.column(1).slice(i, 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                block = pa.array(np.full(len(q), batch.column(0)[i].as_py(), np.int32))
                cells = [block, pa.array(np.arange(len(q), dtype=np.int32)), V.to_lists(q)]
                yield pa.RecordBatch.from_arrays(cells, names=["block", "at", "factors"])

    flat = basis.select("block", "q").mapInArrow(rows, "block int, at int, factors array<double>")
    return materialize(side.index.join(flat, ["block", "at"]).select(side.key, "factors"), f"svd-{side.key}-factors")


def singular_value_table(factors: SvdFactors) -> DataFrame:
    """Singular values as (component, value) rows."""
    rows = [
        F.struct(F.lit(i).alias("component"), F.lit(float(v)).alias("singular_value"))
        for i, v in enumerate(factors.singular_values)
    ]
    return factors.user_factors.sparkSession.range(1).select(F.inline(F.array(*rows)))
