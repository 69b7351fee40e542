"""Hierarchical language identification: the family first, then the language within it.

Features are hashed byte n-grams (two to four bytes) of the lower-cased letters of the whole text.
Linear support vector machines, one for each pair of families, choose the family; one for each pair
of its languages chooses among these closely related ones. They are fitted on a bounded sample
(about ``per_language`` rows of each language, drawn by the hash of the key) and then score every
text in one pass; only the text is an input of a prediction.

Defined results: a null text or one without letters is ``und`` with score 0; languages outside the
table of families form a family of their own; null languages are not learned; with a single learned
language every text with letters gets it, with score 1; without any, ``und``. Repeated rows get equal
predictions, empty tables give empty results, other columns of the input are never read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from stargauge.llm.common import remainder, table

UNKNOWN = "und"

#: Language codes by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("yue", "zh"),
}

NOT_LETTERS = re.compile(r"[\W\d_]+")
SIZES = (2, 3, 4)
TABLE = 1 << 16
#: Bytes whose n-grams are looked up at once.
BYTES_AT_ONCE = 1 << 18


def family_of(language: str) -> str:
    short = re.split(r"[-_]", language.lower())[0]
    return next((name for name, codes in FAMILIES.items() if short in codes), f"only-{language}")


def letters_of(text: str | None) -> bytes:
    """The lower-cased letters in UTF-8, runs of anything else as one blank; nothing without letters."""
    letters = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {letters}    ".encode("utf-8", "replace") if any(map(str.isalpha, letters)) else b""


def gram_indices(data: np.ndarray) -> list[np.ndarray]:
    """For every byte but the last three, the table rows of the n-grams that start there."""
    b = data.astype(np.uint32)
    two = b[:-3] | (b[1:-2] << 8)
    three = two | (b[2:-1] << 16)
    four = three | (b[3:] << 24)
    spread = [((x * np.uint32(0x9E3779B1)) >> 16) for x in (three, four)]
    return [x.astype(np.intp) for x in (two, *spread)]


def gram_counts(letters: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram features and their share of all n-grams of one text."""
    rows = gram_indices(np.frombuffer(letters, np.uint8))
    ids, counts = np.unique(np.concatenate([r + k * TABLE for k, r in enumerate(rows)]), return_counts=True)
    return ids, (10.0 * counts / len(rows[0])).astype(np.float32)


def fit_svm(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, epochs: int = 8, penalty: float = 1e-4, seed: int = 3
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (subgradient steps, averaged at the end)."""
    draw = np.random.default_rng(seed)
    v, scale, bias = np.zeros(len(SIZES) * TABLE), 1.0, 0.0
    total, total_bias, kept, step = np.zeros_like(v), 0.0, 0, int(1 / penalty / 10)
    balance = {s: len(signs) / (2 * max(1, (signs == s).sum())) for s in (-1, 1)}
    for epoch in range(epochs):
        for i in draw.permutation(len(rows)):
            ids, values = rows[i]
            step += 1
            rate = 1 / (penalty * step)
            margin = signs[i] * (scale * (v[ids] @ values) + bias)
            scale *= 1 - rate * penalty
            if margin < 1:
                push = rate * signs[i] * balance[signs[i]]
                v[ids] += push / scale * values
                bias += 0.01 * push
        if epoch >= epochs // 2:
            total, total_bias, kept = total + scale * v, total_bias + bias, kept + 1
    return total / kept, total_bias / kept


@dataclass
class LanguageModel:
    """Languages, their families and the pairwise machines: ``pairs`` names what the columns decide."""

    languages: list[str] = field(default_factory=list)
    pairs: list[tuple[str, str, str]] = field(default_factory=list)
    weights: np.ndarray | None = None
    biases: np.ndarray | None = None
    scales: np.ndarray | None = None

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """The pairwise margins of each text (all with letters), one column per machine."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        sums = np.zeros((len(texts), len(self.pairs)))
        for a in range(0, len(data), BYTES_AT_ONCE):
            part = data[a : a + BYTES_AT_ONCE + 3]
            if len(part) < 4:
                break
            rows = gram_indices(part)
            found = self.weights[0].take(rows[0], axis=0)
            for k in range(1, len(SIZES)):
                found += self.weights[k].take(rows[k], axis=0)
            first = np.searchsorted(starts, a, "right") - 1
            last = np.searchsorted(starts, a + len(found), "left")
            bounds = np.maximum(starts[first:last] - a, 0)
            # The last three bytes of a text start no n-gram of their own.
            ends = np.minimum(starts[first + 1 : last + 1] - 3 - a, len(found))
            running = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0, dtype=np.float64)])
            sums[first:last] += running[np.maximum(ends, bounds)] - running[bounds]
        return 10.0 * sums / (lengths - 3)[:, None] + self.biases

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text, given as :func:`letters_of`."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if t]
        if not some or not self.languages:
            return names, scores
        if len(self.languages) == 1:
            for i in some:
                names[i], scores[i] = self.languages[0], 1.0
            return names, scores
        odds = 1 / (1 + np.exp(-np.clip(self.margins([texts[i] for i in some]) * self.scales, -30, 30)))
        families = sorted({family_of(x) for x in self.languages})
        by_family = self.shares("", families, odds)
        chosen = by_family.argmax(axis=1)
        for f, name in enumerate(families):
            members = [x for x in self.languages if family_of(x) == name]
            at = np.flatnonzero(chosen == f)
            within = self.shares(name, members, odds[at])
            best = within.argmax(axis=1)
            for i, j in zip(at.tolist(), best.tolist()):
                names[some[i]] = members[j]
            scores[np.array(some)[at]] = by_family[at, f] * within[np.arange(len(at)), best]
        return names, np.clip(scores, 0, 1)

    def shares(self, level: str, classes: list[str], odds: np.ndarray) -> np.ndarray:
        """Shares of the classes of one level: the product of a class's pairwise odds, normalised."""
        logs = np.zeros((len(odds), len(classes)))
        for k, (at, x, y) in enumerate(self.pairs):
            if at == level and x in classes:
                logs[:, classes.index(x)] += np.log(odds[:, k] + 1e-12)
                logs[:, classes.index(y)] += np.log(1 - odds[:, k] + 1e-12)
        grown = np.exp(logs - logs.max(axis=1, keepdims=True)) if len(logs) else logs
        return grown / grown.sum(axis=1, keepdims=True) if len(logs) else grown


def fit_languages(rows: list[tuple[str, bytes]]) -> LanguageModel:
    """One machine for each pair of families and each pair of languages of one family."""
    languages = sorted({x for x, t in rows if t})
    grams = [(x, family_of(x), gram_counts(t)) for x, t in rows if t]
    families = sorted({f for _, f, _ in grams})
    tasks = [("", *p) for p in itertools.combinations(families, 2)]
    for f in families:
        tasks += [(f, *p) for p in itertools.combinations([x for x in languages if family_of(x) == f], 2)]
    if not tasks:
        return LanguageModel(languages)
    columns, biases, scales = [], [], []
    for level, x, y in tasks:
        some = [((f if level == "" else lang), g) for lang, f, g in grams if (f if level == "" else lang) in (x, y)]
        signs = np.array([1 if name == x else -1 for name, _ in some])
        w, b = fit_svm([g for _, g in some], signs)
        right = signs * np.array([w[ids] @ values + b for _, (ids, values) in some])
        columns.append(w)
        biases.append(b)
        scales.append(4 / max(1e-6, float(np.median(right))))
    stacked = np.stack(columns, axis=1).reshape(len(SIZES), TABLE, -1).astype(np.float32)
    return LanguageModel(languages, tasks, stacked, np.array(biases), np.array(scales))


def training_sample(
    docs: DataFrame, per_language: int, ident: str = "doc_id", max_train_bytes: int = 32768
) -> list[tuple[str, bytes]]:
    """About ``per_language`` texts of each language, drawn by the hash of the key; very long ones are left out."""
    labelled = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") <= max_train_bytes))
    rates = labelled.groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col(ident)), F.lit(1_000_000)) / 1_000_000
    # One row per language.
    drawn = labelled.join(F.broadcast(rates), "lang").where(draw < F.col("rate")).select("lang", "text", ident)

    def letters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [letters_of(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), batch.column(2)], names=["lang", "letters", ident]
            )

    kind = docs.schema[ident].dataType.simpleString()
    rows = drawn.mapInArrow(letters, f"lang string, letters binary, {ident} {kind}")
    return [(r["lang"], bytes(r["letters"])) for r in rows.orderBy(ident, "lang", "letters").collect()]


def add_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``; columns of these names are replaced."""
    kept = docs.drop("lang_pred", "lang_score")
    schema = StructType(list(kept.schema.fields)).add("lang_pred", StringType()).add("lang_score", DoubleType())

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                names, scores = model.predict([letters_of(x) for x in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, "lang_pred", "lang_score"],
                )

    return kept.mapInArrow(mapped, schema)


def op4_language_id(spark: SparkSession, sf_dir: str, per_language: int = 1000) -> DataFrame:
    """Predicted language of every document; keys with remainder 0 modulo 5 are held out."""
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(remainder("doc_id", 5) != 0).select("doc_id", "lang", "text")
    model = fit_languages(training_sample(learned, per_language))
    found = add_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )
