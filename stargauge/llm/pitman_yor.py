"""Language-model scores by a hierarchical Pitman-Yor process over words.

Restaurants are contexts: every word is one, for the tokens right after it (the end for a text's first
token). All share the root restaurant as their parent: a context's tables are the root's customers, and a
new table at the root is a word never seen. A token's probability is its share of its dish's customers less
the discount of their tables, plus the mass of new tables times the parent's probability. Table counts are
sampled by Gibbs sweeps in which all customers of a dish leave a restaurant and sit down again one after
another (in growing groups beyond the first 64), and predictive probabilities are averaged over the kept sweeps.

How it runs. A task cuts some texts (a chunk) into tokens and deals them, as (word, word before, text), to the
parts of the vocabulary by the word's hash. Words of at least ``1 / FREQUENT`` of the tokens are dealt by the
word before as well, so that no part gets all occurrences of a frequent word. A part asks the owners of its
words and contexts (by hash) for their counts, seats the customers of its pairs, sends the owners its tables,
and gets back each word's and context's tables of all parts. Then it scores its tokens and sends every text
one sum. The first shuffle is read again by each step. While seating, a part estimates the tables of other
parts from its own share of each restaurant and dish; the counts and tables in probabilities are exact.

Words are identified by 64-bit hashes. Defined results: a null text has the end token only; rows are
scored one by one, so repeated rows get equal scores; a null key counts as remainder 0 and is trained
on; with no training rows every token is unknown and has probability 1 as the only event; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.common import remainder, table
from stargauge.session import materialize

#: A text's last token, and the context of its first; no word is empty.
END = b""
#: Words with about one in so many tokens are dealt by the word before as well. No result hangs on the choice.
FREQUENT = 1 << 12
CHUNK_TOKENS = 2_000_000
TOKENS_PER_PART = 3_000_000
SAMPLES, BURN_IN = 3, 2
STRENGTH = 1.0

BLOCK, TEXTS, ASKED, COUNTED, SEATED, TABLES, STATS, TOTALS, SCORED = range(9)


def tokens_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def packed(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, protocol=5), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.decompress(data))


def planes(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 as rows of bytes, lowest first, which compress better."""
    kind = np.uint16 if numbers.max(initial=0) < 1 << 16 else np.uint32
    return np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T)


def from_planes(rows: np.ndarray) -> np.ndarray:
    kind = np.uint16 if len(rows) == 2 else np.uint32
    return np.ascontiguousarray(rows.T).view(kind).ravel().astype(np.int32)


def frequent_words(rows: DataFrame) -> tuple[list[bytes], int]:
    """Words of about ``1 / FREQUENT`` of all tokens or more, and the number of tokens.

    They only say which words are dealt by context, too. A group of texts reports words of at least a quarter of
    that share.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        total = 0

        def report() -> pa.RecordBatch:
            some = [(w, n) for w, n in counts.items() if n * FREQUENT * 4 >= total]
            words = pa.array([None, *[w for w, _ in some]], pa.binary())
            return pa.RecordBatch.from_arrays([words, pa.array([total, *[n for _, n in some]], pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                words = tokens_of(text.as_py())
                counts.update(words)
                total += len(words)
                if total >= CHUNK_TOKENS:
                    yield report()
                    counts, total = Counter(), 0
        if total:
            yield report()

    sums = rows.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    sums = materialize(sums, "frequent-words")
    total = sums.where("word IS NULL").select("n").first()
    if total is None:
        return [], 0
    frequent = sums.where("word IS NOT NULL").where(F.col("n") * FREQUENT >= total[0])
    return sorted(bytes(r["word"]) for r in frequent.select("word").collect()), total[0]


class Chunk:
    """Tokens of some texts."""

    def __init__(self, frequent: Iterable[bytes] = ()) -> None:
        self.words: dict[bytes, int] = {END: 0}
        self.frequent = frequent
        self.streams: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, ident: object, held_out: bool, text: str | None) -> None:
        words = self.words
        ids = np.array([words.setdefault(w, len(words)) for w in tokens_of(text)], np.int32)
        self.streams.append(ids)
        self.rows.append((ident, held_out))
        self.size += len(ids)

    def finish(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """Blocks by part: hashes of words, then each token's word, context (both as places there) and text.

        A text's number is twice its place in the chunk, and one more if it is held out.
        """
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        often = np.zeros(len(hashes), bool)
        often[[self.words[w] for w in self.frequent if w in self.words]] = True
        word = np.concatenate(self.streams)
        before = np.concatenate([[0], word[:-1]]).astype(np.int32)  # texts end with the end, number 0
        numbers = np.array([2 * i + bool(held) for i, (_, held) in enumerate(self.rows)], np.int32)
        text = np.repeat(numbers, [len(s) for s in self.streams])
        kind = np.uint16 if parts <= 1 << 16 else np.int32
        part = (hashes % np.uint64(parts)).astype(kind)[word]
        split = np.flatnonzero(often[word])
        mixed = (hashes[word[split]] ^ (hashes[before[split]] * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(7)
        part[split] = (mixed % np.uint64(parts)).astype(kind)
        order = np.argsort(part, kind="stable")
        met, first = np.unique(part[order], return_index=True)
        for p, a, b in zip(met.tolist(), first, [*first[1:], len(order)]):
            mine = order[a:b]
            used, place = np.unique(np.concatenate([word[mine], before[mine]]), return_inverse=True)
            texts = np.diff(text[mine], prepend=0)
            yield p, packed(hashes[used], planes(place[: b - a]), planes(place[b - a :]), planes(texts))


def kneser_ney_discount(once: float, twice: float) -> float:
    """The usual estimate of a discount from the dishes met once and twice, kept inside (0, 1)."""
    return float(min(0.95, max(0.05, once / (once + 2 * twice)))) if once + twice else 0.5


def narrow(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the smallest type that holds them."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


class Part:
    """Tokens of one part: their words and contexts as places in ``keys``, the sorted hashes."""

    def __init__(self, blocks: list[tuple[int, bytes]], parts: int) -> None:
        blocks = sorted(blocks)
        opened = [unpacked(data) for _, data in blocks]
        self.chunks = [chunk for chunk, _ in blocks]
        self.keys = np.unique(np.concatenate([x[0] for x in opened])) if opened else np.zeros(0, np.uint64)
        found = [np.searchsorted(self.keys, x[0]).astype(np.int32) for x in opened]
        none = [np.zeros(0, np.int32)]
        self.word = np.concatenate([f[from_planes(x[1])] for f, x in zip(found, opened)] or none)
        self.context = np.concatenate([f[from_planes(x[2])] for f, x in zip(found, opened)] or none)
        texts = [np.cumsum(from_planes(x[3]), dtype=np.int32) for x in opened]
        self.ends = np.cumsum([len(t) for t in texts]).tolist()
        self.text = np.concatenate(texts or none)
        owner = (self.keys % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(owner, kind="stable")
        self.owners, first = np.unique(owner[self.order], return_index=True)
        self.bounds = [*first.tolist(), len(owner)]

    def counts(self) -> np.ndarray:
        """Training tokens of each key as a word of this part."""
        return np.bincount(self.word[self.text % 2 == 0], minlength=len(self.keys))

    def by_owner(self, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """The columns of the arrays' last dimension that belong to each owner."""
        for q, a, b in zip(self.owners.tolist(), self.bounds, self.bounds[1:]):
            yield q, packed(*[narrow(x[..., self.order[a:b]]) for x in arrays])

    def from_owners(self, answers: dict[int, bytes]) -> list[np.ndarray]:
        """The arrays of all owners' answers put together, in the order of the keys."""
        opened = [unpacked(answers[q]) for q in self.owners.tolist()]
        back = np.argsort(self.order)
        return [np.concatenate([x.astype(np.int64) for x in column], axis=-1)[..., back] for column in zip(*opened)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word, context and training count of each distinct pair, and the tokens' places among them."""
        codes = self.word * np.int64(len(self.keys)) + self.context
        pairs, place = np.unique(codes, return_inverse=True)
        counts = np.bincount(place[self.text % 2 == 0], minlength=len(pairs))
        return pairs // len(self.keys), pairs % len(self.keys), counts, place.astype(np.int32)


@dataclass
class Seating:
    """Table counts of one part's dishes, sampled by Gibbs sweeps."""

    words: np.ndarray  # of each pair, from 0
    contexts: np.ndarray
    counts: np.ndarray  # customers of each pair, positive
    totals: np.ndarray  # training tokens of each key over all parts, which are its customers as a context
    all_tokens: int
    seed: int

    def sample(self) -> np.ndarray:
        """Tables of each pair, one row per kept sweep."""
        draw = np.random.default_rng(self.seed)
        n = len(self.totals)
        discount = kneser_ney_discount((self.counts == 1).sum(), (self.counts == 2).sum())
        scale = self.totals / np.maximum(np.bincount(self.contexts, self.counts, n), 1)
        dish_scale = self.totals / np.maximum(np.bincount(self.words, self.counts, n), 1)
        share_of_all = self.all_tokens / max(self.counts.sum(), 1)
        tables = np.ones(len(self.counts), np.int64)
        kept = []
        many = np.flatnonzero(self.counts > 1)
        many = many[np.argsort(self.counts[many], kind="stable")]
        sizes = self.counts[many]
        for sweep in range(BURN_IN + SAMPLES):
            root = np.bincount(self.words, tables, n)
            root_discount = kneser_ney_discount((root == 1).sum(), (root == 2).sum())
            context_tables = np.bincount(self.contexts, tables, n) * scale
            share = ((root * dish_scale)[self.words[many]] - root_discount) / (STRENGTH + max(tables.sum() * share_of_all, 1))
            pull = (STRENGTH + discount * context_tables[self.contexts[many]]) * share
            seated, t = 1, np.ones(len(many))
            while seated < sizes.max(initial=0):
                step = 1 if seated < 64 else seated // 16
                a = np.searchsorted(sizes, seated, "right")  # dishes with more customers to come
                group = np.minimum(step, sizes[a:] - seated)
                old = np.maximum(seated + (group - 1) / 2 - discount * t[a:], 1e-9)
                t[a:] += draw.binomial(group, pull[a:] / (pull[a:] + old))
                seated += step
            tables[many] = t
            if sweep >= BURN_IN:
                kept.append(tables.copy())
        return np.array(kept)


@dataclass
class Restaurants:
    """What the probabilities need besides counts: totals of all parts."""

    n_tokens: int
    n_words: int
    discount: float
    root_discount: float
    tables: np.ndarray  # of each sample

    def logs(self, n_word, n_context, counts, tables, roots, of_context) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the base probability and of the model's.

        By pair: the word's and the context's training tokens, the pair's, and for each sample the pair's tables,
        the word's root customers and the context's tables.
        """
        base = np.log10((n_word + 1.0) / (self.n_tokens + self.n_words + 1))
        total = np.zeros(len(counts))
        for s in range(SAMPLES):
            fresh = STRENGTH + self.root_discount * self.n_words
            root = np.where(n_word > 0, roots[s] - self.root_discount, fresh) / (STRENGTH + self.tables[s])
            mass = STRENGTH + self.discount * of_context[s]
            total += (counts - self.discount * tables[s] + mass * root) / (STRENGTH + n_context)
        return base, np.log10(np.minimum(total / SAMPLES, 1.0))


def of_kind(items: list[tuple], kind: int) -> list[tuple]:
    return [x[1:] for _, x in items if x[0] == kind]


class Model:
    """The steps of all parts over the texts of ``doc_id, held_out, text`` rows; each returns (part, message) pairs."""

    def __init__(self, rows: DataFrame, frequent: list[bytes], parts: int) -> None:
        self.parts = parts
        dealt = rows.select("doc_id", "held_out", "text").rdd.mapPartitionsWithIndex(cutting(frequent, parts))
        self.tokens = self.shuffled(dealt)
        self.asked = self.step(asking(parts), self.tokens)
        self.counted = self.step(counting, self.asked)
        self.n_tokens, self.n_words = self.total(word_totals, 2, self.asked)
        self.seated = self.step(seating(parts, self.n_tokens), self.tokens, self.counted)
        self.returned = self.step(returning, self.asked, self.seated)
        once, twice, root_once, root_twice, *tables = self.total(table_totals, 4 + SAMPLES, self.seated, self.asked)
        self.restaurants = Restaurants(
            self.n_tokens, self.n_words, kneser_ney_discount(once, twice), kneser_ney_discount(root_once, root_twice),
            np.array(tables),
        )

    def shuffled(self, messages: RDD) -> RDD:
        return messages.partitionBy(self.parts)

    def together(self, *inputs: RDD) -> RDD:
        """Messages of all inputs, part by part; they lie alike, so none is moved."""
        return inputs[0] if len(inputs) == 1 else inputs[0].context.union(list(inputs))

    def step(self, function, *inputs: RDD) -> RDD:
        return self.shuffled(self.together(*inputs).mapPartitionsWithIndex(function))

    def total(self, function, n: int, *inputs: RDD) -> list[int]:
        """Sums of the ``n`` numbers of each part."""
        found = self.together(*inputs).mapPartitionsWithIndex(function)
        return np.sum([np.zeros(n, np.int64), *found.collect()], axis=0).tolist()

    def scores(self) -> RDD:
        parts = self.parts
        sums = self.step(scoring(parts, self.restaurants), self.tokens, self.counted, self.seated, self.returned)
        return self.together(self.tokens, sums).mapPartitionsWithIndex(summing(self.n_tokens))


def place_of(chunk: int) -> int:
    """Where a chunk's texts lie."""
    return (chunk >> 24) + (chunk & 0xFFFFFF)


def cutting(frequent: list[bytes], parts: int):
    def cut(index: int, rows: Iterator) -> Iterator[tuple]:
        number, chunk = index << 24, Chunk(frequent)

        def finished() -> Iterator[tuple]:
            for p, data in chunk.finish(parts):
                yield p, (BLOCK, number, data)
            yield place_of(number), (TEXTS, number, pickle.dumps(chunk.rows))

        for ident, held_out, text in rows:
            chunk.add(ident, held_out, text)
            if chunk.size >= CHUNK_TOKENS:
                yield from finished()
                chunk, number = Chunk(frequent), number + 1
        if chunk.rows:
            yield from finished()

    return cut


def asking(parts: int):
    def ask(p: int, messages: Iterator) -> Iterator[tuple]:
        part = Part(of_kind(messages, BLOCK), parts)
        counts = part.counts()
        for q, a, b in zip(part.owners.tolist(), part.bounds, part.bounds[1:]):
            mine = part.order[a:b]
            yield q, (ASKED, p, packed(part.keys[mine], narrow(counts[mine])))

    return ask


def gathered(messages: list[tuple]) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
    """Askers, the bounds of their keys, the places of all keys asked for among the distinct ones, training tokens of these."""
    asked = sorted(of_kind(messages, ASKED))
    opened = [unpacked(data) for _, data in asked]
    if not opened:
        return [], [0], np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([x[0] for x in opened]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([x[1].astype(np.float64) for x in opened]), len(keys)).astype(np.int64)
    return [p for p, _ in asked], np.cumsum([0, *[len(x[0]) for x in opened]]).tolist(), place, counts


def counting(q: int, messages: Iterator) -> Iterator[tuple]:
    askers, bounds, place, counts = gathered(list(messages))
    for p, a, b in zip(askers, bounds, bounds[1:]):
        yield p, (COUNTED, q, packed(narrow(counts[place[a:b]])))


def word_totals(q: int, messages: Iterator) -> Iterator[list[int]]:
    counts = gathered(list(messages))[3]
    yield [int(counts.sum()), int((counts > 0).sum())]


def seating(parts: int, all_tokens: int):
    def seat(p: int, messages: Iterator) -> Iterator[tuple]:
        messages = list(messages)
        part = Part(of_kind(messages, BLOCK), parts)
        if not part.chunks:
            return
        (totals,) = part.from_owners(dict(of_kind(messages, COUNTED)))
        words, contexts, counts, _ = part.pairs()
        met = counts > 0
        words, contexts, of_met = words[met], contexts[met], counts[met]
        tables = Seating(words, contexts, of_met, totals, all_tokens, p).sample()
        yield p, (SEATED, p, packed(narrow(tables)))
        yield p, (STATS, int((of_met == 1).sum()), int((of_met == 2).sum()))
        sums = [np.array([np.bincount(x, t, len(part.keys)) for t in tables]).astype(np.int64) for x in (words, contexts)]
        for q, data in part.by_owner(*sums):
            yield q, (TABLES, p, data)

    return seat


def owned_tables(messages: list[tuple]) -> tuple[list[int], list[int], np.ndarray, list[np.ndarray]]:
    """Askers, bounds and places as :func:`gathered` has them, and each key's tables as a word and as a context."""
    askers, bounds, place, counts = gathered(messages)
    opened = [unpacked(data) for _, data in sorted(of_kind(messages, TABLES))]
    sums = [np.zeros((SAMPLES, len(counts)), np.int64) for _ in range(2)]
    for k, total in enumerate(sums):
        for s in range(SAMPLES if opened else 0):
            total[s] = np.bincount(place, np.concatenate([x[k][s].astype(np.float64) for x in opened]), len(counts))
    return askers, bounds, place, sums


def returning(q: int, messages: Iterator) -> Iterator[tuple]:
    askers, bounds, place, sums = owned_tables(list(messages))
    for p, a, b in zip(askers, bounds, bounds[1:]):
        yield p, (TOTALS, q, packed(*[narrow(x[:, place[a:b]]) for x in sums]))


def table_totals(q: int, messages: Iterator) -> Iterator[list[int]]:
    """Pairs and root dishes of one and of two customers, then the tables of each sample."""
    messages = list(messages)
    pairs = np.sum([(0, 0), *of_kind(messages, STATS)], axis=0).tolist()
    roots = owned_tables(messages)[3][0]
    yield [*pairs, int((roots[0] == 1).sum()), int((roots[0] == 2).sum()), *roots.sum(axis=1).tolist()]


def scoring(parts: int, model: Restaurants):
    def score(p: int, messages: Iterator) -> Iterator[tuple]:
        messages = list(messages)
        part = Part(of_kind(messages, BLOCK), parts)
        if not part.chunks:
            return
        (totals,) = part.from_owners(dict(of_kind(messages, COUNTED)))
        roots, of_context = part.from_owners(dict(of_kind(messages, TOTALS)))
        ((_, data),) = of_kind(messages, SEATED)
        words, contexts, counts, place = part.pairs()
        tables = np.zeros((SAMPLES, len(counts)), np.int64)
        (tables[:, counts > 0],) = unpacked(data)
        n_word = totals[words]
        base, logs = model.logs(n_word, totals[contexts], counts, tables, roots[:, words], of_context[:, contexts])
        known = n_word > 0
        for chunk, a, b in zip(part.chunks, [0, *part.ends], part.ends):
            texts, at = np.unique(part.text[a:b] >> 1, return_inverse=True)
            mine = place[a:b]
            sums = [np.bincount(at, x) for x in (base[mine], logs[mine])]
            whole = [narrow(np.bincount(at, x).astype(np.int64)) for x in (None, known[mine])]
            yield place_of(chunk), (SCORED, chunk, packed(planes(np.diff(texts, prepend=0)), *whole, *sums))

    return score


SCORES = (
    "doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "perplexity double"
)


def summing(n_tokens: int):
    def summed(_: int, messages: Iterator) -> Iterator[tuple]:
        messages = list(messages)
        scored: dict[int, list[bytes]] = {}
        for chunk, data in sorted(of_kind(messages, SCORED)):
            scored.setdefault(chunk, []).append(data)
        for chunk, data in of_kind(messages, TEXTS):
            rows = pickle.loads(data)
            sums = np.zeros((4, len(rows)))
            for part in scored.pop(chunk):
                texts, *columns = unpacked(part)
                texts = np.cumsum(from_planes(texts))
                for total, x in zip(sums, columns):
                    total[texts] += x
            for (ident, held), n, known, base, score in zip(rows, *sums.tolist()):
                yield ident, held, int(n), int(known), n_tokens, base, score, float(10 ** min(300.0, -score / n))

    return summed


def score_documents(rows: DataFrame) -> DataFrame:
    """Scores of ``doc_id, held_out, text`` rows by a model of those that are not held out."""
    spark = rows.sparkSession
    frequent, total = frequent_words(rows)
    kind = SCORES.format(kind=rows.schema["doc_id"].dataType.simpleString())
    if not total:
        return spark.createDataFrame([], kind)
    # A part's tokens are held by one task, so their number follows the corpus.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TOKENS_PER_PART)
    return spark.createDataFrame(Model(rows, frequent, parts).scores(), kind, verifySchema=False)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; keys with remainder 2 modulo 7 are held out."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "text"))
