"""Genre vocabularies of any size: a (genre, place) table and rows that carry only the places they need.

Nothing here is a list on the driver or a column per genre. Genres are looked up per distinct genre text, of
which there are at most as many as movies, and rows meet their text's places in one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genres as G
from ..session import materialize


def text_counts(df: DataFrame) -> DataFrame:
    """``genres, n``: each distinct genre text (null is empty) and its rows."""
    return df.groupBy(F.coalesce("genres", F.lit("")).alias("genres")).agg(F.count(F.lit(1)).alias("n"))


def vocabulary_table(df: DataFrame) -> DataFrame:
    """``genre, place, n``: every genre with its place in sorted order from 0 and the rows that have it.

    Genres are sorted by range, so places are the position in a range plus the sizes of the ranges before.
    """
    counted = text_counts(df).select("n", F.explode(G.tokens("genres")).alias("genre"))
    totals = counted.groupBy("genre").agg(F.sum("n").alias("n"))
    ranged = materialize(
        materialize(totals, "genres").repartitionByRange("genre").withColumn("_range", F.spark_partition_id()), "genres"
    )
    # One row per range, whatever the size of the vocabulary.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select("_range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("genre")) - 1
    placed = ranged.withColumn("_inside", inside).join(offsets, "_range")
    return placed.select("genre", (F.col("_offset") + F.col("_inside")).cast("int").alias("place"), "n")


def text_places(texts: DataFrame, vocabulary: DataFrame, *columns: str) -> DataFrame:
    """``genres, <column lists>``: for each distinct genre text the known genres' columns, in place order.

    Genres outside the vocabulary drop out; a text without known genres gets empty lists.
    """
    pairs = texts.select("genres", F.explode(G.tokens("genres")).alias("genre"))
    found = pairs.join(vocabulary, "genre").groupBy("genres").agg(
        F.sort_array(F.collect_list(F.struct("place", *columns))).alias("_known")
    )
    lists = [F.col("_known")[c].alias(f"{c}s") for c in ("place", *columns)]
    return found.select("genres", *lists)


def add_genre_places(df: DataFrame, vocabulary: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``places`` (and a list per further column of the vocabulary) for the genres of each row."""
    known = text_places(df.select(F.coalesce("genres", F.lit("")).alias("genres")).distinct(), vocabulary, *columns)
    names = [f"{c}s" for c in ("place", *columns)]
    known = known.withColumnRenamed("genres", "_text")
    joined = df.join(known, F.coalesce(df["genres"], F.lit("")) == known["_text"], "left")
    empty = {n: F.coalesce(F.col(n), F.array().cast(known.schema[n].dataType)) for n in names}
    return joined.withColumns(empty).select(*df.columns, *names)
