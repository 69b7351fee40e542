"""Exact standard scaling (population std) and degree-2 interactions of feature arrays."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .moments import array_state, pair_deviations, squared_deviations


@dataclass(frozen=True)
class Moments:
    """Row count, mean and scaling divisor per feature: as small as one feature row."""

    count: int
    mean: list[float]
    scale: list[float]

    def to_dict(self) -> dict:
        return asdict(self)


def divisor(count: int, mean: float, variance: float) -> float:
    """Population std; 1 where the variance is zero up to rounding."""
    eps = float(np.finfo(np.float64).eps)
    if variance <= count * eps * variance + (count * mean * eps) ** 2:
        return 1.0
    return float(np.sqrt(variance))


def _moments(count: int, means: list[float], variances: list[float]) -> Moments:
    scale = [divisor(count, m, v) for m, v in zip(means, variances)]
    return Moments(count, means, scale)


def column_moments(df: DataFrame, columns: list[Column]) -> Moments:
    """Moments of numeric expressions from one aggregation inside generated code."""
    exprs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        exprs += [F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}")]
    row = df.agg(*exprs).first()
    if row["n"] == 0:
        raise ValueError("cannot fit a scaler on an empty table")
    width = range(len(columns))
    return _moments(row["n"], [row[f"m{i}"] for i in width], [row[f"v{i}"] for i in width])


def array_moments(df: DataFrame, column: str, expand: bool = False) -> Moments:
    """Moments of an array column, or of its degree-2 expansion, whose wide rows are never built.

    One pass; deviations are taken from each batch's own mean, which keeps the variance exact for wide
    value ranges.
    """
    state = array_state(df, column, pair_deviations if expand else squared_deviations)
    if state is None:
        raise ValueError("cannot fit a scaler on an empty table")
    return _moments(state.n, state.mean.tolist(), (state.spread / state.n).tolist())


def scaled_columns(columns: list[Column], moments: Moments) -> list[Column]:
    """(x - mean) / scale per expression."""
    return [
        (c - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, moments.mean, moments.scale)
    ]


def scale_array(df: DataFrame, column: str, moments: Moments, name: str | None = None) -> DataFrame:
    mean, scale = np.array(moments.mean), np.array(moments.scale)
    return df.withColumn(name or column, V.array_map(lambda x: (x - mean) / scale)(column))


def pairwise_interactions(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Inputs, then every product of two different inputs; no squares and no constant."""
    return df.withColumn(name or column, V.array_map(V.expand_pairs)(column))


def scaled_interactions(df: DataFrame, column: str, moments: Moments, name: str | None = None) -> DataFrame:
    """Expansion and scaling in one Arrow pass."""
    mean, scale = np.array(moments.mean), np.array(moments.scale)
    apply = V.array_map(lambda x: (V.expand_pairs(x) - mean) / scale)
    return df.withColumn(name or column, apply(column))
