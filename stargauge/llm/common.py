"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words everywhere in this package.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key has the remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(modulus)), F.lit(0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def plain(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
