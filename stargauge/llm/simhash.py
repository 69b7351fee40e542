"""SimHash near duplicates, linked through pivot distance tables.

A text's fingerprint has a bit for every bit that is set in over half of its shingles' hashes. The
distinct fingerprints get a row of a distance table: their Hamming distances to many reference
fingerprints, kept separately for each of ``blocks`` bit blocks (the sum over the blocks is the
distance to the whole reference). Two fingerprints that differ in at most ``bits`` bits agree
entirely on at least ``blocks - bits`` blocks, and then also on those blocks' distances to every
reference. So each choice of that many blocks gives an equi-join key, and no link is lost. Inside a
bucket, pairs whose coordinates differ by more than ``bits`` for some reference are discarded by the
triangle inequality, and the survivors are verified bit by bit.

Buckets larger than ``tile`` are cut into tiles that are compared in separate tasks, and a bucket
gives a spanning forest of its links instead of all of them, so that groups of copies of any size
cost bounded memory and few rows; components stay exactly those of all links.

Defined results: a null text or one without words has the fingerprint zero and is linked like any
other; texts of fewer words than a shingle are one shingle; equal texts share a fingerprint, so
repeated rows always share a component; a null doc_id takes part in links but is never a component's
id unless no other id is in reach. Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from stargauge.llm.common import table
from stargauge.llm.components import connected_components
from stargauge.session import materialize

#: Shingle hashes expanded to bits at once.
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text as a signed long."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, HASHES_AT_ONCE):
        some = words[start : start + HASHES_AT_ONCE + width - 1]
        shingles = zip(*(some[i:] for i in range(width))) if len(some) >= width else [some]
        hashes = np.array([digest(b" ".join(s), seed) for s in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > count, bitorder="little")
    return int(packed.view(np.int64)[0])


def add_fingerprints(docs: DataFrame, text: str = "text", into: str = "simhash", width: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of each text as a long; a column named ``into`` is replaced."""
    kept = docs.drop(into)
    schema = StructType(list(kept.schema.fields)).add(into, LongType())

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x, width) for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, into]
            )

    return kept.mapInArrow(mapped, schema)


def references(count: int, seed: int = 7) -> list[int]:
    """``count`` random reference fingerprints as signed longs."""
    draw = random.Random(seed)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(count)]


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of bits that cover the 64 bits, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def block_distances(fp: Column, mask: int, pivots: list[int]) -> Column:
    """The distances to every reference within one block, as one array."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("byte") for p in pivots])


def linked_tile(fps: np.ndarray, coordinates: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some fingerprints (unsigned), as pairs of their positions."""
    edges, waiting = [], np.arange(len(fps))
    while len(waiting):
        stack, waiting = [waiting[0]], waiting[1:]
        while stack and len(waiting):
            x = stack.pop()
            gap = np.abs(coordinates[waiting] - coordinates[x]).max(axis=1)
            near = waiting[gap <= bits]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= bits]
            if len(near):
                edges += [(x, y) for y in near]
                stack += near.tolist()
                waiting = np.setdiff1d(waiting, near, assume_unique=True)
    return edges


def link_fingerprints(
    fps: DataFrame, bits: int = 3, blocks: int = 5, pivots: int = 16, tile: int = 2048, column: str = "fp"
) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints whose components are those of all links."""
    if blocks <= bits:
        raise ValueError("more blocks than bits are needed")
    refs, masks = references(pivots), block_masks(blocks)
    base = fps.select(F.col(column).alias("fp")).where(F.col("fp").isNotNull()).distinct()
    distances = base.select("fp", *[block_distances(F.col("fp"), m, refs).alias(f"d{i}") for i, m in enumerate(masks)])
    choices = list(itertools.combinations(range(blocks), blocks - bits))
    keys = F.array(*[F.xxhash64(F.lit(n), *[F.col(f"d{i}") for i in some]) for n, some in enumerate(choices)])
    keyed = distances.select("fp", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1")
    shared = materialize(shared.select("key", F.ceil(F.col("count") / tile).cast("int").alias("parts")), "buckets")
    own = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("parts")).cast("int")
    tiles = (
        keyed.join(shared, "key")
        .withColumn("own", own)
        .select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "fp")
    )
    pivot_values = np.array(refs, np.int64).view(np.uint64)  # numpy counts the bits of absolute values

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in tile_runs(batches):
            bare = run.view(np.uint64)
            edges = linked_tile(bare, distance_table(bare, pivot_values), bits)
            if edges:
                at = np.array(edges)
                yield pa.RecordBatch.from_arrays([pa.array(run[at[:, 0]]), pa.array(run[at[:, 1]])], names=["a", "b"])

    return tiles.mapInArrow(linked, "a long, b long")


def distance_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances to every reference: one row per fingerprint."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def tile_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of each (key, i, j) in a sorted stream of batches."""
    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp, i, j = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(key)]):
            name = (key[start], i[start], j[start])
            if name != last and held:
                yield np.unique(np.concatenate(held))
                held = []
            last = name
            held.append(fp[start:end])
    if held:
        yield np.unique(np.concatenate(held))


def component_ids(prints: DataFrame, ident: str = "doc_id", column: str = "simhash", bits: int = 3) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct fingerprint of a table of ids and fingerprints."""
    distinct = prints.groupBy(F.col(column).alias("fp")).agg(F.min(ident).alias("first_id"))
    distinct = materialize(distinct, "fingerprints")
    roots = connected_components(link_fingerprints(distinct, bits))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    joined = joined.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    heads = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(heads, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident, fingerprint (16 hex digits), component_id`` for every row."""
    prints = add_fingerprints(docs.select(F.col(ident), F.col(text)), text).select(ident, "simhash")
    prints = materialize(prints, "simhash")
    classes = materialize(component_ids(prints, ident), "components")
    return prints.join(classes, prints["simhash"] == classes["fp"]).select(
        ident, F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))
