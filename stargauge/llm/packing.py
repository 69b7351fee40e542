"""Mixture-controlled packing of token streams into fixed windows.

Every source is a queue of documents. Queues are served by deficit round-robin: a source is due a
quantum of tokens each time its credit, which grows with its target share, has paid for one. Serving
the quanta in the order of these due times fills each window to the target proportions, and what a
source is owed (or has had too much) carries over from window to window; no partition starts anew.

In Spark the due time of a source's b-th quantum is ``(b + 1/2) / share``, so the schedule is a range
partitioning by due time and running token counts: positions within a partition plus the totals of
the partitions before it. A queue is never gathered in one task, and no state passes through the
driver but totals. A queue that runs dry leaves its part to the others, in their proportions.

Windows hold ``window`` tokens; the tokens left at the end fill windows of falling powers of two, so
nothing is padded. Each token of each document lies in exactly one piece.

Defined results: a null or empty text is the end token alone; rows with a null source form the queue
``""`` together with rows of that source; a null doc_id is packed like any other; repeated rows are
packed as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stargauge.llm.common import table
from stargauge.session import materialize

WINDOW = 2048
QUANTUM = 128
END_ID = 1
SEGMENTS_PER_PART = 1_000_000
#: Words whose ids a Python worker keeps; beyond this the memo starts anew.
MEMO_WORDS = 800_000

WORD = re.compile(r"[^ \t\n\r]+")
#: Characters that str.split takes for white space and tokenizers do not.
ODD_BLANK = re.compile("[\x1c-\x1f]")
#: The one letter whose lower case is longer; its ids depend on what stands behind it.
GROWING = "\u0130"
#: Signs that end a run of letters (quotes and angle brackets may begin something longer).
STOPS = ".,!?;:#$%&*()[]{}+-=/\\@^_~"
PIECE_SCHEMA = (
    "doc_id {ident}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, source string"
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the 256 bytes: printable ones as themselves, others from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(others)}


class Memo(dict):
    """Ids by word; a word not met before is looked up once, by ``learn``."""

    learn = None

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.learn(word)
        return found


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space, so that words can be encoded apart.

    Ids are kept as little-endian unsigned 32-bit bytes. Words met before are looked up in a memo
    that lives as long as the Python worker. Where the tokenizer lower-cases and parts letters from
    stops (tried on ``PROBES`` when it is loaded), a word's letters are encoded once for all its
    spellings, and runs of letters go to the merges directly.
    """

    PROBES = ("The", "ELLE", "Éçeau", "größe", "ciónasta.", "it's,", "worthless!!", "Ñoño;", "naïve.", "ab.c", "x1.")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        home = sys.modules.setdefault("_stargauge_word_memo", types.ModuleType("_stargauge_word_memo"))
        if getattr(home, "path", None) != path:
            home.path, home.tokenizer, home.memo, home.direct = path, Tokenizer.from_file(path), Memo(), None
        self.tokenizer, self.memo, self.letters = home.tokenizer, home.memo, byte_letters()
        self.merge = self.tokenizer.model.tokenize
        if home.direct is None:
            home.direct = all(self.by_parts(w) == self.whole([w])[0] for w in self.PROBES)
            self.memo.clear()
        self.direct = home.direct
        self.memo.learn = self.by_parts

    def whole(self, words: list[str]) -> list[bytes]:
        """Encode words in one call: their places in the joined text tell their ids apart."""
        done = []
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
            cuts = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in some])) * 4
            data = np.array(found.ids, "<u4").tobytes()
            done += [data[x:y] for x, y in zip([0, *cuts.tolist()], cuts.tolist())]
        return done

    def run_of_letters(self, word: str) -> bytes | None:
        """Ids of a run of letters; None for anything else."""
        if not word.isalpha():
            return None
        if not word.isascii():
            # The tokenizer composes first and then lower-cases each letter by itself.
            if "\u03a3" in word or not unicodedata.is_normalized("NFC", word):
                return None
            word = word.lower().encode().decode("latin-1").translate(self.letters)
        try:
            return array("I", [t.id for t in self.merge(word)]).tobytes()
        except Exception:
            return None

    def by_parts(self, word: str) -> bytes:
        """Ids of a word from those of its lower-case letters and of the stops behind them."""
        low = word
        if word.isascii():
            low = word.lower()
        elif "A" <= word[0] <= "Z" and word[1] < "\x80":
            low = word[0].lower() + word[1:]
        core = low.rstrip(STOPS)
        if not core or core == low or not core[-1].isalpha() or "<|" in word:
            core = low
        found = self.memo.get(core)
        if found is None:
            found = self.run_of_letters(core)
            if found is None:
                (found,) = self.whole([core])
            self.memo[core] = found
        if core == low:
            return found
        tail = low[len(core) :]
        if tail not in self.memo:
            (self.memo[tail],) = self.whole([tail])
        return found + self.memo[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [(WORD.findall(x) if ODD_BLANK.search(x) else x.split()) if x and GROWING not in x else [] for x in texts]
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        if not self.direct:
            new = list({w for words in split for w in words if w not in memo})
            memo.update(zip(new, self.whole(new)))
        found = [b"".join(map(memo.__getitem__, words)) for words in split]
        for i, x in enumerate(texts):
            if x and GROWING in x:
                found[i] = np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        return found


def tokenized(docs: DataFrame, path: str, ident: str = "doc_id") -> DataFrame:
    """One row per input row: ``row, doc_id, queue, n_tokens, ids`` (compressed), in the shared folder.

    ``row`` numbers the rows of a task upwards from a base of its own; the written table fixes it.
    """
    columns = docs.select(
        F.col(ident).alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue"),
        F.col("text"),
    )
    kind = columns.schema["doc_id"].dataType.simpleString()

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = WordEncoder(path), zstandard.ZstdCompressor(level=1)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                ids = [x + end for x in encoder.encode(part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([packer.compress(x) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "queue", "n_tokens", "ids"],
                )

    found = columns.mapInArrow(mapped, f"doc_id {kind}, queue string, n_tokens long, ids binary")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "tokens")


def queue_positions(lengths: DataFrame) -> DataFrame:
    """``lengths`` (row, queue, n_tokens) with ``position``: the tokens before a row in its queue.

    A queue's rows stand in the order of ``row``, whose upper bits are the writing task; so a running
    sum inside each task plus the sums of the tasks before gives the position.
    """
    parted = lengths.withColumn("part", F.shiftright("row", 33))
    sums = parted.groupBy("queue", "part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("queue", "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("queue", "part").orderBy("row")
    running = parted.withColumn("ahead", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    joined = running.join(bases, ["queue", "part"])
    return joined.withColumn("position", F.col("base") + F.col("ahead")).drop("base", "ahead", "part")


def shares_of(lengths: DataFrame, targets: dict[str, float] | None) -> DataFrame:
    """Every queue's share: a positive target where one is given, else its share of all tokens."""
    totals = lengths.groupBy("queue").agg(F.sum("n_tokens").cast("double").alias("queue_tokens"))
    whole = F.sum("queue_tokens").over(Window.partitionBy(F.lit(1)))
    share = F.col("queue_tokens") / whole
    if targets:
        if min(targets.values()) <= 0:
            raise ValueError("targets must be positive")
        given = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        share = F.coalesce(F.try_element_at(given, F.col("queue")).cast("double"), share)
    return totals.select("queue", share.alias("share"))


def scheduled(lengths: DataFrame, targets: dict[str, float] | None, quantum: int, total: int) -> DataFrame:
    """Segments (row, queue, start, position, length) with ``at``, their place among all tokens."""
    placed = queue_positions(lengths).join(shares_of(lengths, targets), "queue")
    first, last = F.col("position"), F.col("position") + F.col("n_tokens")
    cut = placed.withColumn(
        "turn", F.explode(F.sequence(F.floor(first / quantum), F.floor((last - 1) / quantum)))
    )
    begin = F.greatest(first, F.col("turn") * quantum)
    segments = cut.select(
        "row",
        "queue",
        (begin - first).alias("start"),
        begin.alias("place"),
        (F.least(last, (F.col("turn") + 1) * quantum) - begin).alias("length"),
        ((F.col("turn") + 0.5) / F.col("share")).alias("due"),
    )
    parts = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, total // (quantum * SEGMENTS_PER_PART))
    dealt = segments.repartitionByRange(parts, "due", "queue").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "schedule")
    sums = dealt.groupBy("part").agg(F.sum("length").alias("part_tokens"))
    # One row per partition of the schedule, whatever the size of the corpus.
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("due", "queue", "place")
    running = dealt.withColumn("ahead", F.sum("length").over(inside) - F.col("length"))
    return running.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("ahead"))


def tail_windows(total: int, window: int) -> list[tuple[int, int]]:
    """Start and size of the windows behind the last full one: falling powers of two."""
    at, left = total - total % window, total % window
    found = []
    while left:
        size = 1 << (left.bit_length() - 1)
        found.append((at, size))
        at, left = at + size, left - size
    return found


def pieces_of(segments: DataFrame, total: int, window: int) -> DataFrame:
    """``sequence_id, row, start, length, offset``: segments cut at windows and joined per document."""
    full, tail = total // window, tail_windows(total, window)
    at, length = F.col("at"), F.col("length")
    behind = F.array(*[F.lit(a) for a, _ in tail]).cast("array<bigint>")
    next_cut = (F.floor(at / window) + 1) * window
    cuts = F.array_sort(F.filter(F.concat(F.array(next_cut), behind), lambda c: (c > at) & (c < at + length)))
    edges = F.array_distinct(F.concat(F.array(at), cuts, F.array(at + length)))
    whole = (at + length <= next_cut) & (at + length <= full * window)
    split = F.when(whole, F.array(F.struct(at.alias("a"), (at + length).alias("b")))).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(edges) - 1),
            lambda i: F.struct(F.element_at(edges, i).alias("a"), F.element_at(edges, i + 1).alias("b")),
        )
    )

    def sequence_of(a: Column) -> Column:
        return F.when(a < full * window, F.floor(a / window)).otherwise(
            F.lit(full - 1) + F.size(F.filter(behind, lambda c: c <= a))
        )

    cut = segments.select("row", "queue", "place", "start", "at", F.explode(split).alias("cut"))
    shift = F.col("cut.a") - F.col("at")
    parts = cut.select(
        sequence_of(F.col("cut.a")).cast("long").alias("sequence_id"),
        "row",
        "queue",
        (F.col("place") + shift).alias("place"),
        (F.col("start") + shift).alias("start"),
        (F.col("cut.b") - F.col("cut.a")).alias("length"),
    ).repartition("sequence_id")
    # A queue's tokens in one window are neighbours in the queue, so a document's segments join up.
    merged = parts.groupBy("sequence_id", "row", "queue").agg(
        F.min("place").alias("place"), F.min("start").alias("start"), F.sum("length").alias("length")
    )
    inside = Window.partitionBy("sequence_id").orderBy("queue", "place")
    return merged.withColumn("offset", F.sum("length").over(inside) - F.col("length"))


def pack(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    path: str | None = None,
    ident: str = "doc_id",
) -> DataFrame:
    """All pieces of all documents: document, place in it, window, place there, checksum of the ids."""
    if not 0 < quantum <= window:
        raise ValueError("the quantum must lie between 1 and the window")
    tokens = tokenized(docs, path or tokenizer_path(), ident)
    lengths = tokens.select("row", "queue", "n_tokens")
    total = lengths.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    pieces = pieces_of(scheduled(lengths, targets, quantum, total), total, window)
    listed = pieces.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    met = tokens.join(listed, "row").select("doc_id", "queue", "n_tokens", "ids", "pieces")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(with_checksums, PIECE_SCHEMA.format(ident=kind))


def with_checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece, with the crc32 of its ids as little-endian unsigned 32-bit numbers."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            lists = part.column(4)
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            start, length, sequence, offset = (flat.field(k) for k in range(4))
            starts, lengths = (x.to_numpy(zero_copy_only=False) for x in (start, length))
            sums, at = np.empty(len(flat), np.int64), 0
            for packed, count in zip(part.column(3), counts.tolist()):
                ids = memoryview(unpacker.decompress(packed.as_py()))
                for k in range(at, at + count):
                    sums[k] = zlib.crc32(ids[4 * starts[k] : 4 * (starts[k] + lengths[k])])
                at += count
            row = pa.array(np.repeat(np.arange(part.num_rows), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(row), start, length, pa.array(sums),
                    part.column(2).take(row), sequence, offset, part.column(1).take(row),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"],
            )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents; the target of every source is its share of all tokens."""
    return pack(table(spark, sf_dir, "documents"))
