"""Counts, means and centred sums that merge: one pass, exact also far from zero.

A batch gives its count, mean and sums of products of deviations from that mean; two such states merge
without going back to the rows (Chan, Golub, LeVeque 1983). Tasks merge their batches, then their states are
merged in a tree of tasks, so the driver receives one state per group whatever the number of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V

#: States that one task of the tree merges.
FAN_IN = 64


@dataclass
class State:
    """``spread`` holds sums of squared deviations (one per mean), or of all products of two deviations."""

    n: int
    mean: np.ndarray
    spread: np.ndarray

    def merge(self, other: "State") -> "State":
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        gap = other.mean - self.mean
        between = np.outer(gap, gap) if self.spread.ndim == 2 else gap * gap
        spread = self.spread + other.spread + between * (self.n * other.n / n)
        return State(n, self.mean + gap * (other.n / n), spread)


def squared_deviations(rows: np.ndarray) -> State:
    """Mean and squared deviations of every column."""
    mean = rows.mean(axis=0)
    return State(len(rows), mean, ((rows - mean) ** 2).sum(axis=0))


def co_deviations(rows: np.ndarray) -> State:
    """Mean of every column, and the products of deviations of every two columns."""
    mean = rows.mean(axis=0)
    apart = rows - mean
    return State(len(rows), mean, apart.T @ apart)


def pair_deviations(rows: np.ndarray) -> State:
    """Like :func:`squared_deviations` of the columns and their products of two, column by column.

    The products of one column with the later ones are the widest block that is ever built.
    """
    inputs = squared_deviations(rows)
    means, spreads = [inputs.mean], [inputs.spread]
    for i in range(rows.shape[1] - 1):
        block = squared_deviations(rows[:, i : i + 1] * rows[:, i + 1 :])
        means.append(block.mean)
        spreads.append(block.spread)
    return State(len(rows), np.concatenate(means), np.concatenate(spreads))


def _rows_of(states: dict[int, State]) -> Iterator[pa.RecordBatch]:
    for group, state in states.items():
        cells = [[group], [state.n], [state.mean.tobytes()], [state.spread.tobytes()]]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(cells, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["group", "n", "mean", "spread"])


def _state_of(n: int, mean: bytes, spread: bytes) -> State:
    found = State(n, np.frombuffer(mean), np.frombuffer(spread))
    if len(found.spread) != len(found.mean):
        found.spread = found.spread.reshape(len(found.mean), -1)
    return found


def merged_states(df: DataFrame, local: Callable[[pa.RecordBatch], Iterable[tuple[int, State]]]) -> dict[int, State]:
    """The state of every group, from ``local`` of every batch (groups may occur in any number of batches)."""

    def gathered(pairs: Iterable[tuple[int, State]]) -> Iterator[pa.RecordBatch]:
        states: dict[int, State] = {}
        for group, state in pairs:
            states[group] = states[group].merge(state) if group in states else state
        return _rows_of(states)

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(pair for batch in batches if batch.num_rows for pair in local(batch))

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        return gathered((group, _state_of(n, mean, spread)) for group, n, mean, spread in rows)

    schema = "group int, n long, mean binary, spread binary"
    parts = max(1, df.rdd.getNumPartitions())
    states = df.mapInArrow(first, schema)
    while True:
        parts = -(-parts // FAN_IN)
        slot = F.pmod(F.spark_partition_id(), F.lit(parts))
        states = states.repartition(parts, slot).mapInArrow(again, schema)
        if parts == 1:
            break
    return {r["group"]: _state_of(r["n"], r["mean"], r["spread"]) for r in states.collect()}


def array_state(df: DataFrame, column: str, of: Callable[[np.ndarray], State] = squared_deviations) -> State | None:
    """The state of an array column over all rows; None without rows."""

    def local(batch: pa.RecordBatch) -> Iterator[tuple[int, State]]:
        yield 0, of(V.to_matrix(batch.column(0)))

    return merged_states(df.select(column), local).get(0)


def least_squares(state: State, tolerance: float = 1e-10) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the last column on the others, from their :func:`co_deviations`.

    Columns are brought to unit spread first; directions without spread (constant or dependent columns) get
    no weight, which is the shortest solution.
    """
    spread, mean = state.spread, state.mean
    size = np.sqrt(np.diag(spread)[:-1])
    known = size > np.sqrt(state.n) * np.finfo(float).eps * np.abs(mean[:-1])
    unit = np.where(known, size, 1.0)
    inner = spread[:-1, :-1] / np.outer(unit, unit) * np.outer(known, known)
    outer = spread[:-1, -1] / unit * known
    values, vectors = np.linalg.eigh(inner)
    keep = values > values.max(initial=0.0) * tolerance
    weights = vectors[:, keep] @ ((vectors[:, keep].T @ outer) / values[keep]) / unit
    return weights, float(mean[-1] - weights @ mean[:-1])
