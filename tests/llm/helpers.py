"""Rows that operators must survive, and plain versions of what they compute."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Long line of a very long text, once more. " * 4000

#: Names that operators use inside, as extra columns of the input.
CLASHING = ("row", "part", "key", "n", "score", "kept", "simhash", "chunk", "bucket", "queue", "word", "line", "held_out")

ODD_ROWS = [
    (0, "One plain line with several words in it.", "en", "a"),
    (1, None, "en", "a"),
    (2, "", "fr", "b"),
    (3, " \t\n \x0b\r\n", None, None),
    (4, LONG, "en", "a"),
    (5, "same text here, twice", "de", "b"),
    (5, "same text here, twice", "de", "b"),
    (6, "same text here, twice", "de", "c"),
    (None, "a row without a key", "en", "a"),
    (7, "12345 67890 !!! ???", "en", ""),
    (8, "ÄÖÜ ß été ñandú 日本語 😀", "xx", "d"),
    (None, None, None, None),
]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, clashing extra columns."""
    rows = spark.createDataFrame(ODD_ROWS, "doc_id long, text string, lang string, source string")
    return rows.withColumns({name: F.lit("extra") for name in CLASHING}).withColumn("n_chars", F.length("text").cast("long"))


def no_documents(spark):
    return odd_documents(spark).limit(0)


def words(text):
    return WORD.findall(text or "")


def components(nodes, linked):
    """Smallest node reachable from each node, by comparing all pairs."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(nodes)
    for i, x in enumerate(nodes):
        for y in nodes[:i]:
            if linked(x, y):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {x: find(x) for x in nodes}
