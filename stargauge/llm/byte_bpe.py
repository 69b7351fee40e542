"""Byte-level BPE encoding and decoding, with long texts cut into overlapping chunks.

Encoding first splits a text into pre-tokens, whose merges do not depend on each other. A pattern splits from
left to right, so in principle from the beginning of the text; but split from any other place, it soon finds
the same boundaries, and from a common boundary on, all later ones agree. So every chunk is pre-tokenised by
itself and in parallel, whether its start is a boundary or not. Chunks overlap: where the boundaries of a chunk
and of its successor first agree in the overlap, the two are stitched, and each then encodes the pieces between
its own stitch and the next. Boundaries closer to a chunk's end than ``MARGIN`` bytes do not count, since the
text behind could change them. Only if two chunks find no common boundary (one pre-token that fills an overlap)
the document is put together again and pre-tokenised from its beginning.

A text of one chunk is encoded where it lies; chunks of longer texts are dealt over tasks, and only their stitch
places and ids come together again. Decoding looks the ids up and concatenates raw bytes.

Defined results: a null text is an empty one and has no ids; invalid UTF-8 counts as U+FFFD; a null or repeated
``doc_id`` is kept like any other; other columns are ignored; an empty table gives an empty result. Decoding an
id that the vocabulary lacks is an error. A document's text and ids must fit in a task's memory.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from stargauge.llm.common import plain, table
from stargauge.session import materialize

CHUNK_BYTES = 1 << 16
OVERLAP_BYTES = 1 << 10
#: More bytes than any boundary's pre-token looks ahead.
MARGIN = 16
#: Pieces whose ids a Python worker keeps, and the longest of them; beyond this the memo starts anew.
MEMO_PIECES, MEMO_LETTERS = 500_000, 48


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PieceEncoder:
    """Pre-tokens of a text and the ids of each, as little-endian unsigned 32-bit bytes.

    What is loaded and learnt lives as long as the Python worker.
    """

    def __init__(self, path: str, pattern: str) -> None:
        home = sys.modules.setdefault("_stargauge_byte_bpe", types.ModuleType("_stargauge_byte_bpe"))
        if getattr(home, "of", None) != (path, pattern):
            import regex
            import tiktoken

            home.split = regex.compile(pattern).findall
            home.merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
            home.memo, home.of = {}, (path, pattern)
        self.split, self.memo, self.merges = home.split, home.memo, home.merges

    def ids(self, pieces: list[str]) -> bytes:
        memo, found = self.memo, []
        if len(memo) > MEMO_PIECES:
            memo.clear()
        for piece in pieces:
            known = memo.get(piece)
            if known is None:
                known = np.array(self.merges._encode_single_piece(piece), "<u4").tobytes()
                if len(piece) <= MEMO_LETTERS:
                    memo[piece] = known
            found.append(known)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        return self.ids(self.split(text))

    def starts(self, data: bytes, is_last: bool) -> np.ndarray:
        """Where pre-tokens start in a chunk, and the end; letters cut at either edge belong to the neighbours."""
        a, b = 0, len(data)
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        text = data[a:].decode("utf-8", "strict" if is_last else "ignore")
        sizes = [len(p.encode()) for p in self.split(text)]
        return np.cumsum([a, *sizes])


def texts_of(docs: DataFrame, ident: str, text: str) -> DataFrame:
    return docs.select(F.col(ident).alias("doc_id"), F.make_valid_utf8(plain(F.col(text))).cast("binary").alias("data"))


def encoder_of(path: str, pattern: str) -> Callable[[], PieceEncoder]:
    return lambda: PieceEncoder(path, pattern)


def encode_short(texts: DataFrame, encoder: Callable[[], PieceEncoder]) -> DataFrame:
    """Ids of texts of one chunk."""

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [pieces.encode(x.as_py().decode()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(encoded, f"doc_id {kind}, ids binary")


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``row, doc_id, k, is_last, data``: each text in chunks that reach ``overlap`` bytes into the next."""
    last = F.floor((F.length("data") - overlap - 1) / chunk).cast("int")
    # The pieces are made before the explode, so that no row carries the whole text along.
    chunks = F.transform(
        F.sequence(F.lit(0), last),
        lambda k: F.struct(
            k.alias("k"), (k == last).alias("is_last"),
            F.when(k == last, F.substring(F.col("data"), k * chunk + 1, F.length("data")))
            .otherwise(F.substring(F.col("data"), k * chunk + 1, F.lit(chunk + overlap))).alias("data"),
        ),
    )
    numbered = texts.select("doc_id", F.monotonically_increasing_id().alias("row"), chunks.alias("chunks"))
    return numbered.select("row", "doc_id", F.inline("chunks"))


def pretokenise(chunks: DataFrame, encoder: Callable[[], PieceEncoder], chunk: int, overlap: int) -> DataFrame:
    """The chunks with the starts of their pre-tokens, and those in the overlaps by their place in the text."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                k, is_last, data = (one.column(n)[0].as_py() for n in (2, 3, 4))
                starts = pieces.starts(data, is_last)
                places = starts[:-1] + k * chunk
                heads = places[places <= k * chunk + overlap] if k else places[:0]
                tails = places[(places >= (k + 1) * chunk) & (places <= k * chunk + len(data) - MARGIN)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *one.columns,
                        pa.array([starts.astype("<u4").tobytes()], pa.binary()),
                        pa.array([heads.tolist()], pa.list_(pa.int64())),
                        pa.array([tails.tolist() if not is_last else []], pa.list_(pa.int64())),
                    ],
                    names=[*one.schema.names, "starts", "heads", "tails"],
                )

    columns = chunks.select("row", "doc_id", "k", "is_last", "data")
    places = ArrayType(LongType())
    schema = StructType(list(columns.schema.fields)).add("starts", BinaryType()).add("heads", places).add("tails", places)
    return columns.mapInArrow(mapped, schema)


def stitches(chunks: DataFrame) -> DataFrame:
    """``row, k, start, stop, whole``: the part each chunk encodes; ``whole`` where chunks do not resynchronise."""
    along = Window.partitionBy("row").orderBy("k")
    met = F.array_min(F.array_intersect(F.lag("tails").over(along), F.col("heads")))
    stitched = chunks.select("row", "k", "heads", "tails").withColumn("start", F.when(F.col("k") == 0, 0).otherwise(met))
    missing = F.max(F.col("start").isNull()).over(Window.partitionBy("row"))
    return stitched.select("row", "k", "start", F.lead("start").over(along).alias("stop"), missing.alias("whole"))


def encode_long(texts: DataFrame, encoder: Callable[[], PieceEncoder], chunk: int, overlap: int) -> DataFrame:
    """Ids of texts of several chunks."""
    chunks = materialize(cut(texts, chunk, overlap), "chunks")
    split = materialize(pretokenise(chunks.repartition("row", "k"), encoder, chunk, overlap), "pretokenised")
    parts = split.drop("heads", "tails").join(stitches(split), ["row", "k"])
    parts = parts.select("row", "doc_id", "k", "is_last", "data", "starts", "start", "stop", "whole")

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder()
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                k, is_last, data, starts, start, stop, whole = (one.column(n)[0].as_py() for n in range(2, 9))
                if whole:  # the bytes themselves, to be put together
                    part = data if is_last else data[:chunk]
                else:
                    at = np.frombuffer(starts, "<u4").astype(np.int64)
                    a = np.searchsorted(at, start - k * chunk)
                    b = len(at) - 1 if stop is None else np.searchsorted(at, stop - k * chunk)
                    edges = at[a : b + 1].tolist()
                    part = pieces.ids([data[x:y].decode() for x, y in zip(edges, edges[1:])])
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), one.column(2), one.column(8), pa.array([part], pa.binary())],
                    names=["row", "doc_id", "k", "whole", "part"],
                )

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held, last = encoder(), [], None

        def done() -> pa.RecordBatch:
            ids = b"".join(held)
            if last[2]:
                ids = pieces.encode(ids.decode())
            return pa.RecordBatch.from_arrays([last[1], pa.array([ids], pa.binary())], names=["doc_id", "ids"])

        for batch in batches:
            for i in range(batch.num_rows):
                row, whole, part = (batch.column(n)[i].as_py() for n in (0, 3, 4))
                if last is not None and row != last[0]:
                    yield done()
                    held = []
                last = (row, batch.column(1).slice(i, 1), whole)
                held.append(part)
        if last is not None:
            yield done()

    kind = texts.schema["doc_id"].dataType.simpleString()
    coded = parts.mapInArrow(encoded, f"row long, doc_id {kind}, k int, whole boolean, part binary")
    ordered = coded.repartition("row").sortWithinPartitions("row", "k")
    return ordered.mapInArrow(put_together, f"doc_id {kind}, ids binary")


def encode(
    docs: DataFrame,
    path: str | None = None,
    ident: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """``doc_id, ids``: the ids of every text as little-endian unsigned 32-bit bytes."""
    if not MARGIN < overlap <= chunk:
        raise ValueError("the overlap must be longer than the margin and at most a chunk")
    encoder = encoder_of(path or ranks_path(), split_pattern())
    texts = texts_of(docs, ident, text)
    is_short = F.length("data") <= chunk + overlap
    return encode_short(texts.where(is_short), encoder).unionByName(
        encode_long(texts.where(~is_short), encoder, chunk, overlap)
    )


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that its ``ids`` stand for."""
    path = path or ranks_path()

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(path).items()}.__getitem__
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                found = [b"".join(map(tokens, np.frombuffer(x.as_py(), "<u4").tolist())) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.binary())], names=[*part.schema.names, "decoded"]
                )

    rest = encoded.drop("decoded")
    return rest.mapInArrow(mapped, StructType(list(rest.schema.fields)).add("decoded", BinaryType()))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
