"""Scans of rating and movie tables, with stable row ids assigned at the scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .schemas import MOVIES, MOVIES_WITHOUT_TITLE, RATINGS, ROW_ID


#: Quotes are doubled inside quoted values.
CSV_QUOTING = {"quote": '"', "escape": '"'}
#: For reading: a quoted empty value is an empty text and a bare one null, since no value is the mark for null.
CSV_READING = {**CSV_QUOTING, "nullValue": "\x00"}


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ratings from headed CSV with the declared schema (no inference pass)."""
    return _read_csv(spark, path, RATINGS)


def read_movies_csv(spark: SparkSession, path: str, with_title: bool = True) -> DataFrame:
    """Movies from headed CSV; quoted titles may hold commas and doubled quotes.

    ``with_title=False`` reads files that have only ``movieId`` and ``genres``.
    """
    return _read_csv(spark, path, MOVIES if with_title else MOVIES_WITHOUT_TITLE)


def read_ratings_with_row_id(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV plus a dense ``row_id`` in file order (path, then position in the file)."""
    frame = _read_csv(spark, path, RATINGS)
    split = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    return assign_row_id(frame.select("*", split.alias("_split")), "_split").drop("_split")


def assign_row_id(df: DataFrame, order_unit: str | None = None) -> DataFrame:
    """Number the rows 0..n-1 without pulling them into one task.

    The partition-local position comes from ``monotonically_increasing_id``. It changes when a
    plan is recomputed, so it is written out once; the offsets are then a running sum over one row
    per unit (a file split, or a partition), never over the data. ``order_unit`` names a column
    whose values order the units; rows of one unit must sit together in one partition.
    """
    unit = F.col(order_unit) if order_unit else F.spark_partition_id()
    numbered = materialize(
        df.select("*", unit.alias("_unit"), F.monotonically_increasing_id().alias("_position")),
        "row-ids",
    )
    per_unit = numbered.groupBy("_unit").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first")
    )
    before = Window.orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_unit.select(
        "_unit", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        numbered.join(offsets, "_unit")
        .withColumn(ROW_ID, F.col("_offset") + F.col("_position") - F.col("_first"))
        .select(*df.columns, ROW_ID)
    )


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet table at rest; FileNotFoundError when it is missing."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .options(**CSV_READING)
            .option("enforceSchema", False)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
