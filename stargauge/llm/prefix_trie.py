"""The prefix trie of conversations, by peeling the last turn off again and again.

Conversations end at nodes of the trie. Peeling starts at the greatest depth: conversations that end
there join the nodes that survived from below, equal ones merge, every node found this way is reported
with its finished totals, and the rest, stripped of its last turn, is regrouped one level higher. A node
is discovered and aggregated at the same moment; nothing is read twice.

In Spark a conversation is the path of its prefixes' 128-bit hashes. Paths are dealt to tasks by range, so
a task holds neighbouring subtrees and peels them by itself. Only the prefixes of a task's first and last
path may go on in another task: these stay open, with the totals gathered so far, as one row for each of the
two paths. Open rows are few and are peeled in the same way in the next round, until one task can hold them.
Since equal paths are dealt by conversation too, copies of any number spread over tasks. No text travels
with a path.

Defined results: turns are ordered by ``turn``, null first, ties by role and then by a digest of the text;
a null role or text is empty; rows of a null ``conv_id`` belong to no conversation and are left out;
repeated rows are repeated turns; other columns are ignored; an empty table gives no node, not even a root.
A conversation's turns (28 bytes each, without text) must fit in a task's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.common import plain, table, words_of
from stargauge.session import materialize

#: Bytes of a prefix's hash.
WIDTH = 16
#: Bytes of paths that one task peels.
PART_BYTES = 8 << 20
#: Open paths that one task may close.
OPEN_PATHS = 4096
#: Conversation ids that a chunk of a node's list holds at most.
IDS_PER_CHUNK = 1024

#: Totals gathered so far for the prefix of a path at some depth.
TOTALS = pa.list_(pa.struct([(x, pa.int64()) for x in ("depth", "n", "first", "kids", "leaves", "saved")]))
TOTALS_SQL = "totals array<struct<depth:long,n:long,first:long,kids:long,leaves:long,saved:long>>"
PATHS = f"conv_id long, path binary, words binary, {TOTALS_SQL}"
COUNTS = ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
PEELED_TYPES = {
    **dict.fromkeys(("node", "parent", "path", "words"), pa.binary()),
    **dict.fromkeys(COUNTS, pa.int64()),
    "ends": pa.string(),
    "totals": TOTALS,
}
PEELED = f"node binary, parent binary, path binary, words binary, {', '.join(f'{c} long' for c in COUNTS)}, ends string, {TOTALS_SQL}"
ROOT = bytes(WIDTH)


def turn_lists(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: the ordered turns of each conversation, each a digest and its number of words."""
    role, text = plain(F.col("role")), plain(F.col("text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(
        F.col("turn"), role.alias("role"), digest.alias("digest"), F.size(words_of(text)).alias("words")
    )
    lists = rows.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return lists.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))))


def with_shared_heads(lists: DataFrame, family: int = 20, longest: int = 4) -> DataFrame:
    """Conversations whose first turns are those of their family's first conversation.

    Conversation c takes the first h turns of conversation ``c - c % family`` (all if there are fewer, none if
    it is absent) and keeps its own turns after its first h, where h is crc32 of c as text modulo ``longest``.
    """
    own = F.col("turns")
    h = (F.crc32(F.col("conv_id").cast("string")) % longest).cast("int")
    heads = lists.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), F.slice(own, 1, longest - 1).alias("head")
    )
    met = lists.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % family).join(heads, "head_id", "left")
    none = F.slice(own, 1, 0)
    rebuilt = F.concat(F.slice(F.coalesce("head", none), 1, h), F.slice(own, h + 1, F.greatest(F.size(own) - h, F.lit(0))))
    return met.select("conv_id", rebuilt.alias("turns"))


def paths_of(lists: DataFrame) -> DataFrame:
    """Each conversation as the hashes of its prefixes, shortest first, and the words of its turns."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, words, totals = [], [], []
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, path = ROOT, []
                for turn in turns:
                    at = hashlib.blake2b(at + turn["digest"], digest_size=WIDTH).digest()
                    path.append(at)
                paths.append(b"".join(path))
                words.append(np.array([t["words"] for t in turns], "<i4").tobytes())
                totals.append([{"depth": len(path), "n": 1, "first": conv, "kids": 0, "leaves": 0, "saved": 0}])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.binary()), pa.array(words, pa.binary()), pa.array(totals, TOTALS)],
                names=["conv_id", "path", "words", "totals"],
            )

    return lists.select("conv_id", "turns").mapInArrow(mapped, PATHS)


class Node:
    """What is known of a node while its subtree is peeled."""

    __slots__ = ("n", "first", "kids", "leaves", "saved", "path", "ends", "below")

    def __init__(self) -> None:
        self.n = self.kids = self.leaves = self.saved = 0
        self.first = self.path = None
        self.ends: list[int] = []
        self.below: list[dict] = []

    def add(self, n: int, first: int | None, kids: int, leaves: int, saved: int) -> None:
        self.n += n
        self.kids += kids
        self.leaves += leaves
        self.saved += saved
        if first is not None and (self.first is None or first < self.first):
            self.first = first


def peel(paths: list[tuple], last: bool) -> Iterator[dict]:
    """Rows of the nodes of sorted paths ``(conv_id, path, words, totals)``; open paths too unless ``last``.

    ``conv_id`` is null for an open path of an earlier round, whose totals lie at any depth.
    """
    edge: set[bytes] = set()
    if paths and not last:
        edge = {ROOT} | {p[i : i + WIDTH] for p in (paths[0][1], paths[-1][1]) for i in range(0, len(p), WIDTH)}
    waiting: dict[int, list[tuple]] = {}
    for at, (conv, path, words, totals) in enumerate(paths):
        for t in totals:
            waiting.setdefault(t["depth"], []).append((at, conv, t))
    still_open: dict[bytes, Node] = {}
    alive: dict[bytes, Node] = {}
    for depth in range(max(waiting, default=-1), -1, -1):
        for at, conv, t in waiting.pop(depth, ()):
            path = paths[at][1]
            node = alive.setdefault(path[(depth - 1) * WIDTH : depth * WIDTH] if depth else ROOT, Node())
            node.path = at
            node.add(t["n"], t["first"], t["kids"], t["leaves"], t["saved"])
            if conv is not None:
                node.ends.append(conv)
        above: dict[bytes, Node] = {}
        for name, node in alive.items():
            _, path, words, _ = paths[node.path]
            parent = None if not depth else ROOT if depth == 1 else path[(depth - 2) * WIDTH : (depth - 1) * WIDTH]
            is_open = name in edge
            for row in node.below:
                row["parent_conv_id"] = None if is_open else node.first
                yield row
            if node.ends:
                yield from chunks_of(name, node.ends, is_open)
            if is_open:
                still_open[name] = node
                if depth:
                    above.setdefault(parent, Node()).path = node.path
                continue
            leaves = node.leaves if node.kids else 1
            last_words = int(np.frombuffer(words, "<i4", 1, (depth - 1) * 4)[0]) if depth else 0
            saved = node.saved + (node.n - 1) * last_words
            row = {
                "node": name, "depth": depth, "parent": parent, "conv_id": node.first, "n_convs": node.n,
                "n_children": node.kids, "n_leaves": leaves, "saved_tokens": saved,
            }
            if not depth:
                yield row
                continue
            up = above.setdefault(parent, Node())
            up.path = node.path
            up.add(node.n, node.first, 1, leaves, saved)
            up.below.append(row)
        alive = above
    if edge:
        yield from open_rows(paths, still_open)


def chunks_of(name: bytes, ends: list[int], is_open: bool) -> Iterator[dict]:
    """The ids of the conversations that end at a node, ascending, in chunks."""
    ends = sorted(ends)
    for a in range(0, len(ends), IDS_PER_CHUNK):
        some = ends[a : a + IDS_PER_CHUNK]
        yield {"node": name, "conv_id": some[0], "ends": ",".join(map(str, some))}


def open_rows(paths: list[tuple], still_open: dict[bytes, Node]) -> Iterator[dict]:
    """The first and the last path, with the totals of their open nodes, each node once."""
    for _, path, words, _ in (paths[0], paths[-1]):
        totals = []
        for depth in range(len(path) // WIDTH + 1):
            node = still_open.pop(path[(depth - 1) * WIDTH : depth * WIDTH] if depth else ROOT, None)
            if node is not None:
                totals.append(
                    {"depth": depth, "n": node.n, "first": node.first, "kids": node.kids, "leaves": node.leaves, "saved": node.saved}
                )
        if totals:
            yield {"path": path, "words": words, "totals": totals}


def peeled(dealt: DataFrame, last: bool) -> DataFrame:
    """:func:`peel` for each partition of a frame that is sorted by path."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        rows: list[dict] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in PEELED_TYPES.items()], names=list(PEELED_TYPES))

        for row in peel(paths, last):
            rows.append(row)
            if len(rows) >= 4096:
                yield batch_of()
                rows = []
        if rows:
            yield batch_of()

    columns = dealt.select("conv_id", "path", "words", "totals")
    return materialize(columns.mapInArrow(mapped, PEELED), "peeled")


def dealt_by_path(paths: DataFrame, parts: int) -> DataFrame:
    keys = ["path", "conv_id"]
    return paths.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)


def open_paths(done: DataFrame) -> DataFrame:
    return done.where(F.col("path").isNotNull()).select(
        F.lit(None).cast("long").alias("conv_id"), "path", "words", "totals"
    )


def prefix_trie(lists: DataFrame, most_open: int = OPEN_PATHS) -> DataFrame:
    """A row per node of the trie of ``conv_id, turns`` (see :func:`turn_lists`)."""
    paths = materialize(paths_of(lists), "paths")
    size = paths.agg(F.coalesce(F.sum(F.length("path") + F.lit(64)), F.lit(0))).first()[0]
    parts = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES + 1)
    found = [peeled(dealt_by_path(paths, parts), last=False)]
    waiting = open_paths(found[0])
    while (n := waiting.count()) > most_open:
        found.append(peeled(dealt_by_path(waiting, 4 * n // most_open), last=False))
        waiting = open_paths(found[-1])
    found.append(peeled(waiting.repartition(1).sortWithinPartitions("path"), last=True))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    nodes = every.where(F.col("depth").isNotNull())
    # Children of nodes that were open in their round: their parents were finished in a later one.
    later = found[1].where(F.col("depth").isNotNull())
    for more in found[2:]:
        later = later.unionByName(more.where(F.col("depth").isNotNull()))
    parents = later.select(F.col("node").alias("parent"), F.col("conv_id").alias("later_conv_id"))
    ends = ends_digests(every.where(F.col("ends").isNotNull()).select("node", "conv_id", "ends"))
    empty = hashlib.sha256().hexdigest()
    return (
        nodes.join(parents, "parent", "left")
        .join(ends, "node", "left")
        .select(
            "node", "parent", "conv_id", "depth", F.coalesce("parent_conv_id", "later_conv_id").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )


def ends_digests(chunks: DataFrame) -> DataFrame:
    """SHA-256 of each node's list of conversations, read chunk by chunk in ascending order."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            names, sums = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node == name:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    names.append(name)
                    sums.append(state.hexdigest())
                name, state = node, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())], names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    dealt = chunks.repartition("node").sortWithinPartitions("node", "conv_id")
    return dealt.select("node", "ends").mapInArrow(mapped, "node binary, ends_sha256 string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    lists = with_shared_heads(turn_lists(table(spark, sf_dir, "conversations")))
    return prefix_trie(lists).drop("node", "parent")
