"""SentencePiece encoding and decoding over the lattices of distinct words.

Texts are cut into words (runs that no piece of the vocabulary crosses). The lattice of a word has an edge for
every substring that is a piece: substrings grow from each place by one character at a time, as long as some
piece starts with them, by lookups of whole columns of words in the table of the pieces' prefixes. A unigram
vocabulary then takes the path of the highest total score, by a Viterbi fold over the ends. The scores of a BPE
vocabulary are merge ranks, whose sum means nothing: there the word's edges are merged in the order of their
scores, as the format defines it. Characters without a piece become byte pieces. Decoding puts the pieces of the
ids together in order.

Documents are cut in tasks into chunks, which number their distinct words. One shuffle deals each chunk's words,
once, over the parts of the lexicon, and the documents, as numbers of words, over tasks. Each part encodes its
distinct words and answers every chunk with their ids in the order asked; the answers meet the documents where
these lie. The piece table has the size of the vocabulary file and is broadcast; words are never gathered.

Defined results: a null or empty text has no words; invalid UTF-8 counts as U+FFFD; the blank put before a text is
not decoded; equal words are encoded once; a null or repeated ``doc_id`` is kept like any other; an empty table gives
an empty result; words of any length are encoded whole. A document's text and ids must fit in a task's memory.
"""

from __future__ import annotations

import heapq
import pickle
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from stargauge.llm.common import plain, table

#: Fixed value: how the format writes a blank.
BLANK = "▁"
FINE_WORDS = rf"{BLANK}*[\p{{L}}\p{{M}}]+|{BLANK}*\p{{Nd}}|{BLANK}*[^\p{{L}}\p{{M}}\p{{Nd}}{BLANK}]+|{BLANK}+"
COARSE_WORDS = rf"{BLANK}*[^{BLANK}]+|{BLANK}+"
#: Kinds of characters in these patterns.
OTHER, LETTER, DIGIT, GAP = range(4)
#: Words with at least one in so many occurrences of a chunk get its smallest numbers, which take the least room.
FREQUENT = 1 << 16
#: Words up to this length are merged together, one merge of each at a time; longer ones each by a heap.
SHORT = 64
#: Characters of text that are cut at once, bytes of text of a chunk (one document at least), bytes of all texts for each
#: part of the lexicon, characters of a lattice (one word at least) and words that are filled in at once (one document
#: at least). They bound a task's memory only.
CUT_LETTERS, CHUNK_BYTES, PART_BYTES, LATTICE_LETTERS, FILLED_WORDS = 1 << 20, 1 << 24, 1 << 24, 1 << 18, 1 << 18
#: Fixed value: the score of a character without a piece on the path of the highest score.
BYTE_SCORE = -100.0
#: Kinds of messages between tasks.
ASKED, DRAFT, ANSWER = range(3)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as (id, piece, score) without control pieces, the ids of byte pieces, and the kind of model."""

    pieces: tuple[tuple[int, str, float], ...]
    byte_ids: tuple[int, ...]
    bpe: bool

    @property
    def longest(self) -> int:
        return max((len(p) for _, p, _ in self.pieces), default=1)

    @property
    def words(self) -> str:
        """The pattern of words: fine if no piece mixes letters, digits and other signs, or joins digits."""
        return FINE_WORDS if all(unmixed(p.lstrip(BLANK)) for _, p, _ in self.pieces) else COARSE_WORDS


def kind_of(character: str) -> int:
    category = unicodedata.category(character)
    return DIGIT if category == "Nd" else LETTER if category[0] in "LM" else OTHER


def unmixed(piece: str) -> bool:
    kinds = set(map(kind_of, piece))
    return BLANK not in piece and len(kinds) <= 1 and (DIGIT not in kinds or len(piece) == 1)


def load(path: str | None = None) -> Vocabulary:
    """The pieces of a model file."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain_ids = [
        i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    pieces = tuple((i, model.id_to_piece(i), float(model.get_score(i))) for i in plain_ids)
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    # A BPE model numbers its merges: scores fall by whole steps.
    return Vocabulary(pieces, byte_ids, all(s == int(s) for _, _, s in pieces))


def piece_table(vocabulary: Vocabulary) -> SimpleNamespace:
    """The piece table as columns: ids, scores and ranks of pieces, their prefixes, the bytes of ids; and the kinds of characters."""
    scores = np.array([s for _, _, s in vocabulary.pieces], np.float64)
    # A prefix is found by the number of the prefix before its last character, and this character.
    numbers: dict[int, int] = {-1: 0}
    ends = {}
    for k, (_, piece, _) in enumerate(vocabulary.pieces):
        at = 0
        for letter in map(ord, piece):
            at = numbers.setdefault(at << 21 | letter, len(numbers))
        ends[at] = k
    keys = np.array(list(numbers), np.int64)
    order = np.argsort(keys)
    piece_of = np.full(len(keys), -1, np.int32)
    piece_of[list(ends)] = list(ends.values())
    is_fine = vocabulary.words == FINE_WORDS
    kinds = np.fromiter((kind_of(chr(c)) if is_fine else OTHER for c in range(0x110000)), np.uint8, 0x110000)
    kinds[ord(BLANK)] = GAP
    content = {i: p.encode() for i, p, _ in vocabulary.pieces} | {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    return SimpleNamespace(
        bpe=vocabulary.bpe,
        longest=vocabulary.longest,
        ids=np.array([i for i, _, _ in vocabulary.pieces], np.int32),
        scores=scores,
        ranks=np.unique(-scores, return_inverse=True)[1].astype(np.int64),
        byte_ids=np.array(vocabulary.byte_ids, np.int32),
        keys=keys[order],
        prefixes=order,
        piece_of=piece_of,
        kinds=kinds,
        contents=pa.array([content.get(i) for i in range(max(content) + 1)], pa.binary()),
    )


def strings(data: bytes | pa.Buffer, bounds: np.ndarray, kind: pa.DataType = pa.string()) -> pa.Array:
    """The strings between the bounds of their joined bytes."""
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def joined(values: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The joined bytes of strings without nulls, and their bounds."""
    if not len(values):
        return memoryview(b""), np.zeros(1, np.int64)
    bounds = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    return memoryview(values.buffers()[2] or b"")[bounds[0] : bounds[-1]], bounds - bounds[0]


def points(data: memoryview) -> np.ndarray:
    return np.frombuffer(bytes(data).decode().encode("utf-32-le"), np.uint32)


def cut_words(texts: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (see :func:`marked`), and how many each text has; together they are the whole texts."""
    data, bounds = joined(texts)
    raw, kind = np.frombuffer(data, np.uint8), kinds[points(data)]
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[:-1] != GAP) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    begins[np.searchsorted(heads, bounds[:-1][np.diff(bounds) > 0])] = True
    starts = heads[begins]
    return strings(data, np.append(starts, len(raw))), np.diff(np.searchsorted(starts, bounds))


def lattice(codes: np.ndarray, stops: np.ndarray, pieces: SimpleNamespace) -> np.ndarray:
    """``edges[length, place]``: the piece (its place in the table, or -1) that so long a substring of a word is.

    ``codes`` are the characters of words put together, ``stops`` the end of each character's word.
    """
    edges = np.full((pieces.longest + 1, len(codes)), -1, np.int32)
    places, prefixes = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    for length in range(1, pieces.longest + 1):
        inside = places + length <= stops[places]
        places, prefixes = places[inside], prefixes[inside]
        wanted = prefixes << 21 | codes[places + length - 1]
        found = np.minimum(np.searchsorted(pieces.keys, wanted), len(pieces.keys) - 1)
        met = pieces.keys[found] == wanted
        places, prefixes = places[met], pieces.prefixes[found[met]]
        edges[length, places] = pieces.piece_of[prefixes]
    return edges


def merged(edges: np.ndarray, bounds: np.ndarray, pieces: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pieces of words after merging neighbours in the order of score, then place, until no two make a piece."""
    sizes = np.diff(bounds)
    word = np.repeat(np.arange(len(sizes)), sizes)
    is_short = sizes[word] <= SHORT
    start = np.flatnonzero(is_short)
    word, end = word[is_short], start + 1
    done = [merged_long(edges, a, b, pieces) for a, b in zip(bounds[:-1][sizes > SHORT], bounds[1:][sizes > SHORT])]
    never = np.iinfo(np.int64).max
    while len(start):
        # The place in the order of each neighbouring pair, kept at its first; then the first pair of each word.
        length = end[1:] - start[:-1]
        near = np.flatnonzero((word[1:] == word[:-1]) & (length <= pieces.longest))
        piece = edges[length[near], start[near]]
        near, piece = near[piece >= 0], piece[piece >= 0]
        turn = np.full(len(start), never)
        turn[near] = pieces.ranks[piece] << 32 | start[near]
        is_first = np.append(True, word[1:] != word[:-1])
        best = np.minimum.reduceat(turn, np.flatnonzero(is_first))[np.cumsum(is_first) - 1]
        going = best < never
        done.append((start[~going], end[~going]))
        chosen = np.flatnonzero(going & (turn == best))
        end[chosen] = end[chosen + 1]
        going[chosen + 1] = False
        start, end, word = start[going], end[going], word[going]
    starts, ends = (np.concatenate([x[k] for x in done] or [start]) for k in range(2))
    order = np.argsort(starts)
    return starts[order], ends[order]


def merged_long(edges: np.ndarray, a: int, b: int, pieces: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """:func:`merged` for the one word from ``a`` to ``b``."""
    lengths, places = np.nonzero(edges[:, a:b] >= 0)
    ranks = pieces.ranks[edges[lengths, places + a]]
    rank = dict(zip(zip(places.tolist(), (places + lengths).tolist()), ranks.tolist()))
    n = int(b - a)
    ends, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(rank[i, i + 2], i, i + 2) for i in range(n - 1) if (i, i + 2) in rank]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, start, end = heapq.heappop(heap)
        if not alive[start] or ends[start] >= end:
            continue
        middle = ends[start]
        if ends[middle] != end:
            continue
        ends[start], alive[middle] = end, False
        if end < n:
            before[end] = start
            if (start, ends[end]) in rank:
                heapq.heappush(heap, (rank[start, ends[end]], start, ends[end]))
        left = before[start]
        if left >= 0 and (left, end) in rank:
            heapq.heappush(heap, (rank[left, end], left, end))
    starts = np.flatnonzero(alive)
    return starts + a, np.array(ends, np.int64)[starts] + a


def best_path(edges: np.ndarray, bounds: np.ndarray, pieces: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) along each word's path of the highest total score (the longer last piece wins a tie), folded over the ends."""
    sizes = np.diff(bounds)
    # Between the characters of a word lie one more places than it has characters.
    zero = bounds[:-1] + np.arange(len(sizes))
    total, last = np.zeros(bounds[-1] + len(sizes)), np.zeros(bounds[-1] + len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for n in range(1, int(sizes.max(initial=0)) + 1):
        words = order[: np.searchsorted(-sizes[order], -n, side="right")]
        lengths = np.arange(min(n, pieces.longest), 0, -1)[:, None]
        piece = edges[lengths, bounds[words] + n - lengths]
        score = np.where(piece >= 0, pieces.scores[piece], -np.inf) if len(pieces.scores) else np.full(piece.shape, -np.inf)
        score[-1][piece[-1] < 0] = BYTE_SCORE
        score += total[zero[words] + n - lengths]
        best = np.argmax(score, axis=0)
        total[zero[words] + n] = score[best, np.arange(len(words))]
        last[zero[words] + n] = lengths[best, 0]
    starts, ends, words = [], [], np.flatnonzero(sizes)
    left = sizes[words]
    while len(words):
        step = last[zero[words] + left]
        ends.append(bounds[words] + left)
        left = left - step
        starts.append(bounds[words] + left)
        words, left = words[left > 0], left[left > 0]
    none = [np.zeros(0, np.int64)]
    starts, ends = np.concatenate(starts or none), np.concatenate(ends or none)
    order = np.argsort(starts)
    return starts[order], ends[order]


def encode_column(words: pa.Array, pieces: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words put together, and how many each word has."""
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    letters = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(words):
        before = letters[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(letters, before + LATTICE_LETTERS, side="right")))
        bounds = np.append(0, letters[a:b] - before)
        codes = points(joined(words.slice(a, b - a))[0])
        edges = lattice(codes.astype(np.int64), np.repeat(bounds[1:], np.diff(bounds)), pieces)
        starts, ends = (merged if pieces.bpe else best_path)(edges, bounds, pieces)
        piece = edges[ends - starts, starts]
        # A character without a piece has as many ids as bytes.
        raw = codes[starts]
        n = np.where(piece >= 0, 1, 1 + (raw > 0x7F) + (raw > 0x7FF) + (raw > 0xFFFF))
        found = np.repeat(piece, n)
        spelled = raw[piece < 0].astype("<u4").tobytes().decode("utf-32-le").encode()
        known = found >= 0
        found[known] = pieces.ids[found[known]]
        found[~known] = pieces.byte_ids[np.frombuffer(spelled, np.uint8)]
        ids.append(found)
        counts.append(np.diff(np.append(0, np.cumsum(n))[np.searchsorted(starts, bounds)]))
        a = b
    return np.concatenate(ids), np.concatenate(counts)


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``words`` (``word`` the first of them, distinct and not empty) and ``ids``."""
    shared = words.sparkSession.sparkContext.broadcast(piece_table(vocabulary))

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = encode_column(batch.column(0), shared.value)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "ids"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.mapInArrow(mapped, f"{shape}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, key: str = "word", ids: str = "ids") -> DataFrame:
    """``key, text``: the ids of each distinct key put together, byte pieces as the bytes they stand for."""
    spark = encoded.sparkSession
    rows = [(i, bytearray(p, "utf-8")) for i, p, _ in vocabulary.pieces] + [(i, bytearray([b])) for b, i in enumerate(vocabulary.byte_ids)]
    pieces = spark.createDataFrame(rows, "id int, content binary")
    spread = encoded.select(F.col(key), F.posexplode_outer(ids).alias("at", "id"))
    met = spread.join(F.broadcast(pieces), "id", "left")  # one row per piece
    ordered = met.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", "content"))).alias("parts"))
    put = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, F.coalesce(x["content"], F.lit(b""))))
    return ordered.select(key, F.decode(put, "UTF-8").alias("text"))


def marked(text: Column) -> Column:
    """A text with blanks as the format writes them, one before it; a null or empty text is empty."""
    valid = F.make_valid_utf8(plain(text))
    return F.when(F.length(valid) > 0, F.concat(F.lit(BLANK), F.replace(valid, F.lit(" "), F.lit(BLANK)))).otherwise("")


def distinct_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``word, n``: every distinct word and how often it occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_table(vocabulary))

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(cut_words(batch.column(0), shared.value.kinds)[0])
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])

    found = docs.select(marked(F.col(text)).alias("text")).mapInArrow(mapped, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 to 2^32 - 1, by their first, second, third and fourth bytes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def drafts(pieces: Callable[[], SimpleNamespace], tasks: int, parts: int, frequent: int) -> Callable[[Iterable[tuple]], Iterator[tuple[int, bytes]]]:
    """Rows of ``doc_id, text``, in so many tasks, as chunks of numbers of words, and the distinct words of each chunk for each part."""

    def messages(k: int, idents: list, words: list[pa.Array], counts: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        found = pa.concat_arrays(words).dictionary_encode()
        places, lexicon = found.indices.to_numpy(), found.dictionary.cast(pa.binary())
        # Frequent words come first, the others in the order of their first occurrence.
        n = np.bincount(places, minlength=len(lexicon))
        often = n * frequent >= len(places)
        order = np.concatenate([np.flatnonzero(often)[np.argsort(-n[often], kind="stable")], np.flatnonzero(~often)])
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        lexicon = lexicon.take(pa.array(order))
        part = np.fromiter((zlib.crc32(w) % parts for w in lexicon.to_pylist()), np.int64, len(lexicon))
        by_part = np.argsort(part, kind="stable")
        lexicon = lexicon.take(pa.array(by_part))
        data, bounds = joined(lexicon)
        # The name says what the numbers mean, should a lost chunk be cut anew from rows in another order.
        name = (TaskContext.get().partitionId(), k, zlib.crc32(data), len(places))
        to = (name[0] + k * tasks) % parts  # as evenly as chunks can lie
        met, first = np.unique(part[by_part], return_index=True)
        for p, a, b in zip(met.tolist(), first.tolist(), [*first.tolist()[1:], len(by_part)]):
            letters = zstandard.compress(data[bounds[a] : bounds[b]], 1)
            yield p, pickle.dumps((ASKED, name, to, p, letters, packed(np.diff(bounds[a : b + 1]))), 5)
        yield to, pickle.dumps((DRAFT, name, packed(part), packed(number[places]), packed(np.concatenate(counts)), idents), 5)

    def mapped(rows: Iterable[tuple]) -> Iterator[tuple[int, bytes]]:
        k, size = 0, 0
        idents, words, counts, texts, letters = [], [], [], [], 0

        def cut() -> int:
            found = cut_words(pa.array(texts, pa.string()), pieces().kinds)
            words.append(found[0])
            counts.append(found[1])
            texts.clear()
            return len(joined(found[0])[0])

        for ident, text in rows:
            idents.append(ident)
            texts.append(text)
            letters += len(text)
            if letters >= CUT_LETTERS:
                size, letters = size + cut(), 0
            if size >= CHUNK_BYTES:
                yield from messages(k, idents, words, counts)
                k, size = k + 1, 0
                idents, words, counts = [], [], []
        if texts:
            cut()
        if idents:
            yield from messages(k, idents, words, counts)

    return mapped


def answers(pieces: Callable[[], SimpleNamespace]) -> Callable[[Iterable[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]:
    """To each chunk, the ids of the words it asked this part for, in its order."""

    def mapped(messages: Iterable[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        asked, columns = [], []
        for _, message in messages:
            kind, *rest = pickle.loads(message)
            if kind == ASKED:
                name, to, part, letters, sizes = rest
                asked.append((name, to, part))
                columns.append(strings(zstandard.decompress(letters), np.append(0, np.cumsum(unpacked(sizes), dtype=np.int64)), pa.binary()))
        if not asked:
            return
        ends = np.cumsum([len(c) for c in columns])
        found = pa.chunked_array(columns).cast(pa.large_binary()).combine_chunks().dictionary_encode()
        columns.clear()
        ids, counts = encode_column(found.dictionary.cast(pa.binary()).cast(pa.string()), pieces())
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))
        for (name, to, part), a, b in zip(asked, [0, *ends.tolist()], ends.tolist()):
            own = lists.take(found.indices.slice(a, b - a))
            sizes = pc.list_value_length(own).to_numpy(zero_copy_only=False)
            yield to, pickle.dumps((ANSWER, name, part, packed(sizes), packed(own.flatten().to_numpy())), 5)

    return mapped


def filled(pieces: Callable[[], SimpleNamespace]) -> Callable[[Iterable[tuple[int, bytes]]], Iterator[tuple]]:
    """The ``doc_id, ids, text`` of chunks that have met their answers."""

    def documents(answer: dict[int, tuple], part: bytes, numbers: bytes, counts: bytes, idents: list) -> Iterator[tuple]:
        part, numbers, ends = unpacked(part), unpacked(numbers), np.cumsum(unpacked(counts), dtype=np.int64)
        by_part = np.argsort(part, kind="stable")
        met = [answer[p] for p in np.unique(part).tolist()]
        none = [np.zeros(0, np.uint32)]
        sizes = np.concatenate([unpacked(x[0]) for x in met] or none).astype(np.int64)
        flat = np.concatenate([unpacked(x[1]) for x in met] or none).astype(np.int32)
        size, start = np.empty(len(part), np.int64), np.empty(len(part), np.int64)
        size[by_part], start[by_part] = sizes, np.cumsum(sizes) - sizes
        a = 0
        while a < len(ends):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + FILLED_WORDS, side="right")))
            own = numbers[before : ends[b - 1]]
            reach = np.append(0, np.cumsum(size[own]))
            ids = flat[np.repeat(start[own] - reach[:-1], size[own]) + np.arange(reach[-1])]
            bounds = reach[np.append(0, ends[a:b] - before)]
            data, places = joined(pieces().contents.take(pa.array(ids)))
            for ident, x, y in zip(idents[a:b], bounds.tolist(), bounds.tolist()[1:]):
                text = bytes(data[places[x] : places[y]]).decode("utf-8", "replace")
                yield ident, array("i", ids[x:y].tobytes()), text.replace(BLANK, " ").removeprefix(" ")
            a = b

    def mapped(messages: Iterable[tuple[int, bytes]]) -> Iterator[tuple]:
        drafted, answered = {}, defaultdict(dict)
        for _, message in messages:
            kind, name, *rest = pickle.loads(message)
            if kind == DRAFT:
                drafted[name] = rest
            elif kind == ANSWER:
                answered[name][rest[0]] = rest[1:]
        while drafted:
            name, draft = drafted.popitem()
            yield from documents(answered.pop(name, {}), *draft)

    return mapped


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, text`` of every row: its words meet their encodings in order, and ``text`` is what the ids decode to."""
    spark = docs.sparkSession
    # The lexicon grows with the texts, and so does the number of its parts.
    size = docs.agg(F.sum(F.octet_length(text)).alias("size")).first()["size"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    shared = spark.sparkContext.broadcast(piece_table(vocabulary))  # of the size of the vocabulary file
    kind = docs.schema[ident].dataType

    def pieces() -> SimpleNamespace:
        return shared.value

    rows = docs.select(F.col(ident).alias("doc_id"), marked(F.col(text)).alias("text"))
    # Both shuffles deal by the same numbers, so that the answers come to where the drafts lie.
    texts = rows.rdd
    cut = texts.mapPartitions(drafts(pieces, texts.getNumPartitions(), parts, FREQUENT)).partitionBy(parts)
    answered = cut.mapPartitions(answers(pieces)).partitionBy(parts)
    done = spark.sparkContext.union([cut, answered]).mapPartitions(filled(pieces))
    shape = StructType([StructField("doc_id", kind), StructField("ids", ArrayType(IntegerType())), StructField("text", StringType())])
    return spark.createDataFrame(done, shape, verifySchema=False)


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, how many they are, and the text they decode to."""
    encoded = encode_documents(table(spark, sf_dir, "documents"), load())
    return encoded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), "text")
