"""I-Match fingerprints: distinct terms of a band of inverse document frequencies, hashed over lexicons.

The lexicon holds the terms whose inverse document frequency, as a share of its largest possible
value, lies in a band. Document frequencies are counted over all texts and per term (by its 64-bit hash), in
tasks before they are shuffled. What every task needs to know of the lexicon is a bitmap of fixed size
(``SLOTS`` bits): a term is in if both of its bits are set. All terms of the band are; another term is by
chance only, with probability (2 n / SLOTS)^2 for n terms in the band (one in ten thousand at 300,000, one in
ten at ten million), and then in all texts alike.

A text's distinct terms inside the lexicon are sorted and hashed once for the whole lexicon and once
for each of several randomised subsets of it. A subset keeps a term with a chance of ``2**-scale``;
a fingerprint holds some neighbouring scales at which its text meets less than one term a subset, so
that texts of any length can be likened, and one byte tells which. The likeness of two fingerprints
is the share of equal hashes among that of the whole lexicon and those of the subsets of their common
scales in which either has a term; it is 0 when they have no scale in common. A text without any term in the band is fingerprinted on all
its terms.

Defined results: a null text is empty and its fingerprint has no terms; two texts without terms have
the likeness 1, a text with and one without have 0; equal texts have equal fingerprints; rows with
equal keys follow each other in the order of their texts, null keys come first; an empty table gives
an empty result, and the next document of a single one is itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import NumericType

from stargauge.llm.common import table

#: Bits of the lexicon's bitmap, which takes an eighth of this in bytes.
SLOTS = 1 << 26
#: The band of inverse document frequencies, as shares of the largest possible one.
BAND = (0.15, 0.85)
#: Randomised subsets of the lexicon at each scale, and scales in a fingerprint.
REPLICAS, SPAN = 20, 3
NO_TERMS = 255
TERMS_AT_ONCE = 1 << 19
TEXTS_PER_PART = 50_000

TERM = re.compile(r"\w+")


def hashed_terms(text: str) -> np.ndarray:
    """Hashes of a text's distinct terms (lower-cased runs of letters, digits and underscores), sorted."""
    digest = xxhash.xxh64_intdigest
    return np.sort(np.array([digest(t) for t in set(TERM.findall(text.lower()))], np.uint64))


def slots_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each term."""
    return hashes >> np.uint64(38), hashes & np.uint64(SLOTS - 1)


def count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts have each term, summed within the task."""
    held: list[np.ndarray] = []
    size = 0

    def summed() -> pa.RecordBatch:
        terms, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], names=["term", "n"])

    for batch in batches:
        for text in batch.column(0):
            held.append(hashed_terms(text.as_py() or ""))
            size += len(held[-1])
            if size >= TERMS_AT_ONCE:
                yield summed()
                held, size = [], 0
    if held:
        yield summed()


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> bytes:
    """The bitmap of the terms whose inverse document frequency lies in the band.

    At most ``SLOTS`` bits reach the driver, whatever the number of documents or terms.
    """
    total = docs.count()
    if not total:
        return bytes(SLOTS // 8)
    # idf / largest idf = 1 - ln(n) / ln(total)
    share = F.lit(1.0) - F.log(F.col("n")) / F.lit(max(1e-9, np.log(total)))
    counts = docs.select(text).mapInArrow(count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    inside = counts.where(share.between(*band))
    slots = F.array(F.shiftrightunsigned("term", 38), F.col("term").bitwiseAND(F.lit(SLOTS - 1)))
    words = (
        inside.select(F.explode(slots).alias("slot"))
        .groupBy((F.col("slot") / 64).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(pmod(slot, 64) AS int)))").alias("bits"))
    )
    found = words.toArrow()
    bitmap = np.zeros(SLOTS // 64, np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.tobytes()


class Fingerprinter:
    """Fingerprints of texts under one lexicon."""

    def __init__(self, bitmap: bytes) -> None:
        self.bits = np.frombuffer(bitmap, np.uint8)

    def known(self, terms: np.ndarray) -> np.ndarray:
        """Which hashed terms are in the lexicon."""
        first, second = ((self.bits[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 for x in slots_of(terms))
        return (first & second).view(bool)

    def hashes(self, text: str) -> np.ndarray:
        """Scale, hash over the whole lexicon, and 24-bit hashes of the subsets of each scale (0: no term)."""
        terms = hashed_terms(text)
        inside = terms[self.known(terms)]
        if len(inside):
            terms = inside
        found = np.zeros(2 + SPAN * REPLICAS, np.uint32)
        if not len(terms):
            found[0] = NO_TERMS
            return found
        scale = max(1, int(len(terms) - 1).bit_length())
        found[:2] = scale, xxhash.xxh32_intdigest(terms.tobytes())
        mixed = mix(terms[None, :] ^ SALTS[:, None])
        # The trailing zeros of a mixed hash tell in how many of the thinning subsets a term stays.
        level = np.bitwise_count((mixed & (~mixed + np.uint64(1))) - np.uint64(1))
        rows, columns = np.nonzero(level >= scale)
        for k in range(SPAN):
            some = level[rows, columns] >= scale + k
            sums = np.zeros(REPLICAS, np.uint64)
            np.add.at(sums, rows[some], mix(mixed[rows[some], columns[some]]))
            cut = (mix(sums) >> np.uint64(40)).astype(np.uint32)
            met = np.bincount(rows[some], minlength=REPLICAS) > 0
            found[2 + k * REPLICAS : 2 + (k + 1) * REPLICAS] = np.where(met, np.maximum(cut, 1), 0)
        return found


SALTS = np.array([xxhash.xxh64_intdigest(b"lexicon", k) for k in range(REPLICAS)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the constants are odd and otherwise arbitrary."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing subsets, from 0 to 1."""
    if NO_TERMS in (a[0], b[0]):
        return float(a[0] == b[0])
    shift = int(b[0]) - int(a[0])
    if abs(shift) >= SPAN:
        return 0.0
    x, y = a[2:].reshape(SPAN, REPLICAS), b[2:].reshape(SPAN, REPLICAS)
    x, y = x[max(0, shift) : SPAN + min(0, shift)], y[max(0, -shift) : SPAN - max(0, shift)]
    used = (x != 0) | (y != 0)
    return float(((x[used] == y[used]).sum() + (a[1] == b[1])) / (used.sum() + 1))


def as_text(hashes: np.ndarray) -> str:
    """Two hex digits of scale, eight of the whole lexicon's hash, six of each subset's."""
    subsets = hashes[2:].astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes().hex()
    return f"{int(hashes[0]):02x}{int(hashes[1]):08x}{subsets}"


def in_order(docs: DataFrame, ident: str, parts: int) -> DataFrame:
    """``bucket, ahead, doc_id, text``: every row in the range of its key, first rows also in the range before.

    Buckets are ranges between quantiles of the key. The first key of each bucket (one value per
    bucket) tells which rows the bucket before needs to see; they go there with ``ahead`` set. So
    each text is shuffled once, and every row meets the row that follows it.
    """
    kind = docs.schema[ident].dataType
    if not isinstance(kind, NumericType):
        raise TypeError("the documents are ordered by a numeric key")
    steps = 4 * parts
    cuts = docs.stat.approxQuantile(ident, [i / steps for i in range(1, steps)], 0.5 / steps)
    edges = np.unique(np.array(cuts, np.float64))

    def bucket_of(keys: pa.Array) -> np.ndarray:
        values = keys.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        return np.where(np.isnan(values), 0, np.searchsorted(edges, values, "right")).astype(np.int32)

    def bucketed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0))), batch.column(0)], names=["bucket", "key"])

    buckets = docs.select(ident).mapInArrow(bucketed, f"bucket int, key {kind.simpleString()}")
    firsts = buckets.groupBy("bucket").agg(F.max(F.col("key").isNull()).alias("has_null"), F.min("key").alias("key"))
    found = sorted(firsts.collect())  # one row per bucket
    order = [r["bucket"] for r in found]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    first = {r["bucket"]: None if r["has_null"] else r["key"] for r in found}

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bucket_of(batch.column(0))
            keys = batch.column(0).to_pylist()
            leads = [i for i, b in enumerate(at.tolist()) if keys[i] == first[b]]
            rows = np.concatenate([np.arange(len(at)), np.array(leads, int)]).astype(np.int64)
            goal = np.concatenate([at, np.array([before[b] for b in at[leads].tolist()], np.int32)]).astype(np.int32)
            ahead = np.arange(len(rows)) >= len(at)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(goal), pa.array(ahead), *taken.columns], names=["bucket", "ahead", "doc_id", "text"])

    placed = docs.select(ident, "text").mapInArrow(
        spread, f"bucket int, ahead boolean, doc_id {kind.simpleString()}, text string"
    )
    return placed.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "ahead", F.col("doc_id").asc_nulls_first(), "text"
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points from the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_documents(docs: DataFrame, bitmap: bytes, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and the likeness to that and to the next document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap)  # SLOTS / 8 bytes
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // TEXTS_PER_PART)
    plain = docs.select(F.col(ident).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = in_order(plain, "doc_id", parts)
    kind = docs.schema[ident].dataType.simpleString()
    ident_kind = to_arrow_type(docs.schema[ident].dataType)

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprinter(shared.value)
        done: list[tuple] = []
        held = None  # (bucket, doc_id, text, hashes) of the row that waits for the next one

        def finish(row: tuple, following: str, hashes: np.ndarray) -> tuple:
            changed = edited(row[2], following)
            own = prints.hashes(changed)
            return (
                row[1], len(row[2]), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                as_text(row[3]), as_text(own), likeness(row[3], own), likeness(row[3], hashes),
            )

        for batch in batches:
            for bucket, ahead, ident_, content in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if held is not None and held[0] == bucket:
                    hashes = prints.hashes(content)
                    done.append(finish(held, content, hashes))
                    held = None if ahead else (bucket, ident_, content, hashes)
                elif not ahead:
                    held = (bucket, ident_, content, prints.hashes(content))
                if len(done) >= 256:
                    yield records(done)
                    done = []
        if done:
            yield records(done)

    def records(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done))
        names = [x.split()[0] for x in RESULT.split(", ")]
        kinds = [ident_kind, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return ordered.mapInArrow(mapped, RESULT.format(kind=kind))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of its edited text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint_documents(docs, lexicon(docs))
