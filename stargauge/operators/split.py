"""Row splits by key hash: stable under repartitioning and recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import ROW_ID

HASH_RANGE = 2**32


def key_hash(keys: list[str], seed: int) -> Column:
    """First 32 bits of md5(keys|seed) as a number below ``HASH_RANGE``."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_split(
    df: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    keys: list[str] | None = None,
    name: str = "split",
) -> DataFrame:
    """Add ``split`` = 'test' for about ``test_size`` of the rows, else 'train'."""
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1, not {test_size}")
    low = key_hash(keys or [ROW_ID], seed) < F.lit(float(test_size * HASH_RANGE))
    return df.withColumn(name, F.when(low, "test").otherwise("train"))


def train_test(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, keys: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The two sides of the split, without the marker column."""
    marked = hash_split(df, test_size, seed, keys, "_side")
    return (
        marked.filter(F.col("_side") == "train").drop("_side"),
        marked.filter(F.col("_side") == "test").drop("_side"),
    )


def hash_folds(
    df: DataFrame, folds: int = 5, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Add an integer ``fold`` in 0..folds-1."""
    return df.withColumn("fold", (key_hash(keys or [ROW_ID], seed) % folds).cast("int"))
