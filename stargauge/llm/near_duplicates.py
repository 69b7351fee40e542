"""Near duplicates of a given similarity, by wide SimHash fingerprints and pivot distance tables.

Sixty-four bits tell apart copies of a few changed bits; texts whose five-word shingles are 0.8 alike differ in a
sixth of all bits. So a fingerprint here has ``words`` words of 64 bits, each from its own mixing of the shingles'
hashes, and the share of differing bits estimates the angle between two texts' shingle counts. Texts are linked
where that estimate reaches the bits expected at the given similarity plus 1.5 deviations of the estimate.

Distinct fingerprints meet where they agree in one of the runs of ``key_bits`` bits: two texts at 0.8 do so with
probability 0.98, more similar ones nearly always. Within a bucket every fingerprint has its Hamming distances to
reference fingerprints, word by word; a pair is discarded if the words' largest coordinate differences add up to
more than the allowed bits (no pair within them can be), and survivors are verified bit by bit. A bucket gives a
spanning forest of its links. Buckets larger than ``tile`` are cut into tiles compared in separate tasks.

With n distinct texts a bucket holds n / 2^key_bits unrelated ones, so ``key_bits`` (and ``words`` with it) should
grow with the logarithm of the corpus; the default suits some ten million distinct texts.

Defined results: texts without words are copies of each other; texts of fewer words than a shingle are one shingle;
of a group the row of the smallest ``doc_id`` stays (null last), the first one if several have it; all columns are
kept; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from stargauge.llm.components import connected_components
from stargauge.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
WORDS, KEY_BITS, PIVOTS, TILE = 8, 14, 16, 2048
#: Shingles whose bits are counted at once; a byte counts up to 255 of them.
AT_ONCE, BYTE = 255 * 16, 255
#: Buckets up to this size are compared as one matrix.
SMALL = 48


def allowed_bits(similarity: float, words: int) -> int:
    """Differing bits up to which fingerprints are linked, for a Jaccard similarity of shingles."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    n = 64 * words
    return int(n * share + 1.5 * math.sqrt(n * share * (1 - share)))


def wide_fingerprint(text: str | None, words: int = WORDS, width: int = SHINGLE) -> np.ndarray:
    """``words`` unsigned words; bit i is set if it is in over half of the shingles' hashes."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(words, np.uint64)
    count = max(1, len(found) - width + 1)
    ones = np.zeros(64 * words, np.int64)
    digest = xxhash.xxh64_intdigest
    salts = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, count, AT_ONCE):
        some = found[start : start + AT_ONCE + width - 1]
        shingles = zip(*(some[i:] for i in range(width))) if len(some) >= width else [some]
        z = np.array([digest(b" ".join(s)) for s in shingles], np.uint64)[:, None] + salts
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        bits = np.unpackbits((z ^ (z >> np.uint64(31))).view(np.uint8), axis=1, bitorder="little")
        for a in range(0, len(bits), BYTE):
            ones += bits[a : a + BYTE].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > count, bitorder="little").view(np.uint64)


def add_wide_fingerprints(docs: DataFrame, text: str = "text", into: str = "wide", words: int = WORDS) -> DataFrame:
    """``docs`` with the fingerprint of each text as an array of longs."""
    kept = docs.drop(into)
    schema = StructType(list(kept.schema.fields)).add(into, ArrayType(LongType()))

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = [wide_fingerprint(x, words).view(np.int64) for x in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.list_(pa.int64()))], names=[*part.schema.names, into]
                )

    return kept.mapInArrow(mapped, schema)


def key_columns(fingerprint: Column, words: int, key_bits: int) -> Column:
    """An array of (number, bits) hashes, one per whole run of ``key_bits`` bits."""
    mask = (1 << key_bits) - 1
    keys = []
    for n in range(64 * words // key_bits):
        word, at = divmod(n * key_bits, 64)
        run = F.shiftrightunsigned(fingerprint[word], at)
        if at + key_bits > 64:
            run = run.bitwiseOR(F.shiftleft(fingerprint[word + 1], 64 - at))
        keys.append(F.xxhash64(F.lit(n), run.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def coordinates(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to every pivot, word by word: (fingerprints, words, pivots)."""
    return np.bitwise_count(fps[:, :, None] ^ pivots.T[None, :, :]).astype(np.int8)


def linked(fps: np.ndarray, pivots: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some fingerprints, as pairs of their positions."""
    table = coordinates(fps, pivots)

    def near(x: int, others: np.ndarray) -> np.ndarray:
        gap = np.abs(table[others] - table[x]).max(axis=2).sum(axis=1, dtype=np.int64)
        close = others[gap <= bits]
        return close[np.bitwise_count(fps[close] ^ fps[x]).sum(axis=1, dtype=np.int64) <= bits]

    if len(fps) <= SMALL:
        gaps = np.abs(table[:, None] - table[None, :]).max(axis=3).sum(axis=2, dtype=np.int64)
        if (gaps <= bits).sum() == len(fps):
            return []
    edges, waiting = [], np.arange(len(fps))
    while len(waiting):
        stack, waiting = [waiting[0]], waiting[1:]
        while stack and len(waiting):
            x = stack.pop()
            found = near(x, waiting)
            if len(found):
                edges += [(x, y) for y in found]
                stack += found.tolist()
                waiting = np.setdiff1d(waiting, found, assume_unique=True)
    return edges


def link_wide(
    distinct: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, key_bits: int = KEY_BITS, tile: int = TILE
) -> DataFrame:
    """Links ``(a, b)`` among rows ``node, wide`` (distinct) whose components are those of all links found."""
    bits = allowed_bits(similarity, words)
    pivots = np.random.default_rng(7).integers(0, 1 << 64, (PIVOTS, words), np.uint64)
    keyed = distinct.select("node", "wide", F.explode(key_columns(F.col("wide"), words, key_bits)).alias("key"))
    sizes = distinct.select(F.explode(key_columns(F.col("wide"), words, key_bits)).alias("key")).groupBy("key").count()
    # Only buckets above a tile need to be known before the rows are dealt: few, and mostly sent to the tasks.
    large = materialize(
        sizes.where(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("parts")), "buckets"
    )
    tiles = (
        keyed.join(large, "key", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64(F.lit("part"), "node"), F.col("parts")).cast("int"))
        .select("key", "node", "wide", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "wide")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, fps in bucket_runs(batches, words):
            edges = linked(fps, pivots, bits)
            if edges:
                at = np.array(edges)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at[:, 0]]), pa.array(nodes[at[:, 1]])], names=["a", "b"])

    return tiles.mapInArrow(searched, "a long, b long")


def bucket_runs(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes and fingerprints of each (key, i, j) with two rows or more, in a sorted stream of batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return held[0] if len(held) == 1 else tuple(np.concatenate(x) for x in zip(*held))

    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        fps = batch.column(4).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, words)
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(key)]):
            name = (key[start], i[start], j[start])
            if name != last and held:
                if sum(len(n) for n, _ in held) > 1:
                    yield joined()
                held = []
            last = name
            held.append((node[start:end], fps[start:end]))
    if held and sum(len(n) for n, _ in held) > 1:
        yield joined()


def one_of_each(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, words: int = WORDS,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates."""
    numbered = add_wide_fingerprints(docs, text, "__wide", words).withColumn("__row", F.monotonically_increasing_id())
    numbered = materialize(numbered, "fingerprinted")
    rank = F.struct(F.col(ident).isNull().alias("unknown"), F.col(ident).alias("id"), F.col("__row").alias("row"))
    firsts = numbered.groupBy(F.col("__wide").alias("wide")).agg(F.min(rank).alias("head"))
    firsts = materialize(firsts.select("wide", "head", F.col("head.row").alias("node")), "distinct")
    roots = connected_components(link_wide(firsts.select("node", "wide"), similarity, words, key_bits))
    grouped = firsts.select("node", "head").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    heads = grouped.agg(F.min("head").alias("head")).select(F.col("head.row").alias("__row"))
    return numbered.join(heads, "__row", "left_semi").select(docs.columns)
