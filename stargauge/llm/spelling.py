"""Spelling variants of a vocabulary, found through a reduced alphabet.

Every letter is hashed to one of a few symbols. Two words that differ by one inserted, deleted or replaced letter
have reduced forms that differ by at most one such edit, so the reduced form of either lies in the full one-edit
neighbourhood of the other's. Over few symbols that neighbourhood is small: it is generated for each distinct
reduced word, joined to the reduced vocabulary, and the words on both sides are then compared letter by letter.

Reduced words and their neighbours are polynomial hashes modulo 2^64, which makes an edit a few additions; equal
reduced words have equal hashes, and a chance collision only adds a pair that the comparison discards. Words are
counted in tasks before they are shuffled, and pairs are only formed between words whose reduced forms meet.

Defined results: words are maximal runs of ``A-Za-z`` and U+00C0 to U+00FF with ``A-Z`` lower-cased; a null text
has none; a null ``doc_id`` is the empty text where it enters a hash; repeated rows count as often as they occur;
other columns are ignored; an empty table, or one without frequent words, gives an empty result. Ties of the
largest count go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.common import plain, table
from stargauge.session import materialize

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A form is this many times as frequent as its variant.
RATIO = 5
SYMBOLS = 8
#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Distinct words that a task counts before it hands them on.
WORDS_AT_ONCE = 400_000
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RUN = "[A-Za-zÀ-ÿ]"


def word_counts(docs: DataFrame, ident: str = "doc_id", text: str = "text", noise: int = 199, least: int = LEAST_LETTERS) -> DataFrame:
    """``word, n`` for all words of at least ``least`` letters.

    Some words lose a letter: where crc32 h of ``<doc_id>:<word>`` is a multiple of ``noise``, the word's letter
    ``h % length`` is deleted (none if ``noise`` is 0).
    """
    runs = re.compile(f"{RUN}{{{least},}}").findall

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )
            total.clear()
            return found

        for batch in batches:
            for doc, body in zip(*(column.to_pylist() for column in batch.columns)):
                words = Counter(runs(body.translate(LOWER)) if not body.isascii() else runs(body.lower()))
                if noise:
                    start = zlib.crc32(f"{doc}:".encode())
                    for word in list(words):
                        h = zlib.crc32(word.encode(), start)
                        if not h % noise:
                            at, n = h % len(word), words.pop(word)
                            shorter = word[:at] + word[at + 1 :]
                            if len(shorter) >= least:
                                total[shorter] += n
                total.update(words)
                if len(total) >= WORDS_AT_ONCE:
                    yield handed_on()
        if total:
            yield handed_on()

    key = F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("doc_id")
    found = docs.select(key, plain(F.col(text)).alias("text")).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(words: list[str], symbols: int) -> np.ndarray:
    """Words of equal length as rows of symbols from 1 up."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)
    mixed = points * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def prefix_hashes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes of each row, the empty one first, and the powers of the base."""
    powers = np.array([pow(BASE, i, 1 << 64) for i in range(letters.shape[1] + 1)], np.uint64)
    sums = np.cumsum(letters * powers[:-1], axis=1, dtype=np.uint64)
    return np.concatenate([np.zeros((len(letters), 1), np.uint64), sums], axis=1), powers


def neighbourhood(letters: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of each row's full one-edit neighbourhood, itself included; a row may name a hash twice."""
    prefix, powers = prefix_hashes(letters)
    whole = prefix[:, -1:]
    before, after = prefix[:, :-1], whole - prefix[:, 1:]
    alphabet = np.arange(1, symbols + 1, dtype=np.uint64)
    deleted = before + after * np.uint64(BASE_INVERSE)
    replaced = whole[:, :, None] + (alphabet - letters[:, :, None]) * powers[None, :-1, None]
    rest = whole - prefix
    inserted = (prefix + rest * np.uint64(BASE))[:, :, None] + alphabet * powers[None, :, None]
    n = len(letters)
    return np.concatenate([whole, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)], axis=1)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Positions and words of each length, so that numpy treats them together."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        yield at, [words[i] for i in at]


def add_reduced(words: DataFrame, symbols: int) -> DataFrame:
    """``word, n, reduced``: the hash of each word's reduced form."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            found = np.zeros(len(some), np.uint64)
            for at, same in by_length(some):
                found[at] = prefix_hashes(letters_of(same, symbols))[0][:, -1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=["word", "n", "reduced"])

    return words.select("word", "n").mapInArrow(mapped, "word string, n long, reduced long")


def neighbour_keys(examples: DataFrame, symbols: int) -> DataFrame:
    """``reduced, near``: each reduced word with every hash of its neighbourhood, from one word that has it."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                keys = part.column(0).to_numpy(zero_copy_only=False)
                for at, same in by_length(part.column(1).to_pylist()):
                    near = np.sort(neighbourhood(letters_of(same, symbols), symbols), axis=1)
                    first = np.ones(near.shape, bool)
                    first[:, 1:] = near[:, 1:] != near[:, :-1]
                    reduced = np.repeat(keys[at], first.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reduced), pa.array(near[first].view(np.int64))], names=["reduced", "near"]
                    )

    return examples.select("reduced", "word").mapInArrow(mapped, "reduced long, near long")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, other, other_n`` for all words (``word, n``, distinct) that differ by exactly one letter, both ways."""
    reduced = materialize(add_reduced(words, symbols), "reduced")
    examples = reduced.groupBy("reduced").agg(F.min("word").alias("word"))
    others = reduced.select(F.col("reduced").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = neighbour_keys(examples, symbols).join(others, "near").drop("near")
    pairs = reduced.join(met, "reduced")
    return pairs.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def spelling_forms(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, n, n_near, form_n`` of every word of ``word, n``."""
    pairs = near_words(words, symbols)
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    frequent = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    return joined.select(
        "word", F.when(frequent, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, -F.col("best.minus")).alias("form_n"),
    )


def add_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``, the word where a chain of forms ends; every round doubles the steps taken.

    Counts grow by ``ratio`` along a chain, so it has no circle and a few dozen words at most.
    """
    steps = materialize(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = materialize(moved, "steps")
        steps = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            break
    return forms.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, ident: str = "doc_id", text: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word of the documents."""
    words = materialize(word_counts(docs, ident, text).where(F.col("n") >= least_count), "words")
    forms = materialize(spelling_forms(words), "forms")
    return add_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all frequent words of the documents."""
    return spelling_variants(table(spark, sf_dir, "documents"))
