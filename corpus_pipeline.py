"""A corpus pipeline over ``documents``: quality classifier, quality rules, near duplicates, packing.

Every stage takes all rows its predecessor kept. Null texts are scored like empty ones and go with the
rules; a null doc_id is kept or dropped like any other; of repeated rows one stays; an empty table gives
an empty result; other columns are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.byte_cnn import add_quality, fit_quality
from stargauge.llm.common import remainder, table
from stargauge.llm.near_duplicates import one_of_each
from stargauge.llm.packing import pack
from stargauge.llm.quality_rules import line_first
from stargauge.session import materialize

LEAST_QUALITY = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``LEAST_QUALITY``; labels of remainder 2 modulo 4 are not learned."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = fit_quality(docs.where(remainder("doc_id", 4) != 2), labels)
    scored = add_quality(docs, model, into="__quality")
    return scored.where(F.col("__quality") >= LEAST_QUALITY).select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without the lines that failed; ``n_chars`` follows the text."""
    # A generator keeps the verdict in one place; a filter over a plain column would evaluate it again.
    judged = docs.select("*", F.explode(F.array(line_first(F.col("text")))).alias("__rules")).where("__rules.kept")
    cleaned = {"text": F.col("__rules.clean_text")}
    if "n_chars" in docs.columns:
        cleaned["n_chars"] = F.length("__rules.clean_text").cast(docs.schema["n_chars"].dataType)
    return judged.withColumns(cleaned).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 alike or more: the smallest doc_id stays."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, packed to the sources' shares of all tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: The classifier is a trained network, which SQL cannot express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
