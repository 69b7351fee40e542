"""Arrow-batched helpers for wide feature arrays.

Wide element-wise work on arrays runs in interpreted lambdas when written with higher-order
functions. These helpers hand whole Arrow batches to numpy instead; Spark keeps the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List array of equal lengths -> (rows, width) matrix without copying per row.

    Null arrays and arrays of different lengths raise; null elements become NaN.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.empty((0, 0))
    if column.null_count:
        raise ValueError("a feature array is null")
    if len(np.unique(np.diff(column.offsets.to_numpy()))) > 1:
        raise ValueError("feature arrays differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def to_lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def past_nulls(column: pa.Array, function: Callable[[pa.Array], pa.Array], kind: pa.DataType) -> pa.Array:
    """``function`` of the rows that are not null, with null where the input is null."""
    if not len(column) or column.null_count == len(column):
        return pa.nulls(len(column), kind)
    if not column.null_count:
        return function(column)
    known = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    places = np.zeros(len(column), np.int64)
    places[known] = np.arange(len(known))
    found = function(column.take(pa.array(known)))
    return found.take(pa.array(places, mask=column.is_null().to_numpy(zero_copy_only=False)))


def expand_pairs(matrix: np.ndarray) -> np.ndarray:
    """Inputs followed by all products i < j, in row-major order of (i, j)."""
    left, right = np.triu_indices(matrix.shape[1], 1)
    return np.hstack([matrix, matrix[:, left] * matrix[:, right]])


def pair_names(names: list[str]) -> list[str]:
    left, right = np.triu_indices(len(names), 1)
    return list(names) + [f"{names[i]} {names[j]}" for i, j in zip(left, right)]


def array_map(function: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column | str], Column]:
    """Column function array<double> -> array<double> from a matrix function; null stays null."""

    @F.arrow_udf("array<double>")
    def apply(column: pa.Array) -> pa.Array:
        return past_nulls(column, lambda x: to_lists(function(to_matrix(x))), pa.list_(pa.float64()))

    return apply


def array_score(function: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column | str], Column]:
    """Column function array<double> -> double from a matrix-to-vector function; null stays null."""

    @F.arrow_udf("double")
    def apply(column: pa.Array) -> pa.Array:
        return past_nulls(column, lambda x: pa.array(function(to_matrix(x)), pa.float64()), pa.float64())

    return apply


def summed_over_rows(
    df: DataFrame,
    column: str,
    partial: Callable[[np.ndarray], np.ndarray],
    read: Callable[[pa.Array], np.ndarray] = to_matrix,
) -> np.ndarray:
    """Sum over all batches of the vector ``partial(batch matrix)``; ``read`` makes the matrix of a column.

    Each partition sends one vector; Spark adds them up per position, so the driver receives a
    single vector whatever the number of partitions.
    """

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(read(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([to_lists(total.reshape(1, -1))], ["part"])

    partials = df.select(column).mapInArrow(per_partition, "part array<double>")
    totals = (
        partials.select(F.posexplode("part").alias("pos", "v"))
        .groupBy("pos")
        .agg(F.sum("v").alias("v"))
        .toPandas()
        .sort_values("pos")
    )
    return totals["v"].to_numpy()
