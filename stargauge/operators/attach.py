"""Left joins that bring per-key tables to the rating rows, with cold-start rules.

Joins are left without hints: a table that is small in measured bytes is broadcast by the
optimizer, a large one is sort-merged, and adaptive execution splits the rating side of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import require_columns


def attach(df: DataFrame, table: DataFrame, key: str | list[str]) -> DataFrame:
    """Left join ``table`` on ``key``; unknown keys get nulls."""
    keys = [key] if isinstance(key, str) else key
    require_columns(df, keys, "the rating table")
    added = [c for c in table.columns if c not in keys]
    return df.join(table, keys, "left").select(*df.columns, *added)


def fill_defaults(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """Replace nulls of the named columns by fitted defaults."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def attach_zero(df: DataFrame, table: DataFrame, key: str | list[str]) -> DataFrame:
    """Left join with 0 for unknown keys."""
    keys = [key] if isinstance(key, str) else key
    added = [c for c in table.columns if c not in keys]
    return attach(df, table, key).na.fill(0, subset=added)


def attach_factors(
    df: DataFrame, factors: DataFrame, key: str, name: str, width: int
) -> DataFrame:
    """Left join a (key, array) table; unknown keys get the zero vector."""
    zero = F.array_repeat(F.lit(0.0), width)
    return attach(df, factors, key).withColumn(name, F.coalesce(F.col(name), zero))


def cold_start_defaults(mean: float, prefix: str) -> dict[str, float]:
    """Defaults of an unseen key: global mean, no spread, one rating."""
    return {
        f"{prefix}_avg_rating": mean,
        f"{prefix}_std_rating": 0.0,
        f"{prefix}_rating_count": 1.0,
    }
