"""Main text of web pages: page structure plus a suffix array over each host's pages.

A page is read into blocks of three roles: inside an article (or main) element, chrome (menus, ads,
forms, comments and the like, by element, ARIA role or class), and loose text that no markup claims.
Blocks of an article are the text, and chrome is dropped. The token streams of whole pages are put together
per host, and a suffix array finds the substrings of at least ``min_tokens`` tokens that occur on distinct
pages. What they cover is taken out of loose text, whose unique runs stay, be they short or beside an article.

A class or id may say less than an element: an article in a wrapper with a chrome class, or with one of its
own, counts where the page has no other; and a page with nothing but text in such wrappers keeps it as
loose text. An article inside an article that a class marks as chrome (a reader's comment) is dropped.

A host's stream is cut into shards of bounded size, one suffix array each. A loose substring that its own
shard does not repeat is looked up among the windows of the host's other shards, so a host of any size gives
the same result as one suffix array over all of it. (Covering by repeated substrings of at least k tokens is
the same as covering by repeated windows of k tokens; so suffixes are told apart by their first k tokens.)

Defined results: a null or empty page has an empty text; a null url is the host ``""``; rows that are
equal in key, url and html count as one page; other columns are not read; an empty table gives an
empty result. Tokens are compared by 24-bit hashes: two windows that differ are mistaken for each other only
if every token in which they differ collides (for one token about once in 17 million).
"""

from __future__ import annotations

import html as html_module
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stargauge.llm.common import table
from stargauge.session import materialize

MIN_TOKENS = 8
SHARD_TOKENS = 1_000_000

#: HTML element names by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
CHROME = frozenset("aside button dialog footer form head menu nav object select svg video audio canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table caption tbody tfoot "
    "thead tr ul".split()
)
CELLS = frozenset("br td th".split())
#: Elements that a new element of the same name closes.
SELF_CLOSING = frozenset("dd dt li option p td th tr".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog navigation search".split())
#: Words in a class or id that mark chrome.
CHROME_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)(?:>|\Z)|</?[a-zA-Z][^>]*\Z|</[^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[\s_-]+")
LOOSE, ARTICLE, DROPPED = 0, 1, 2
#: Until the page is read: an article that a class speaks against, and text that only a class drops.
DOUBTED, BY_CLASS = 3, 4


def role_of(name: str, attributes: str, outer: int) -> int:
    """The role of an element's text, given that of the element around it."""
    if outer == DROPPED or name in CHROME or (name == "header" and outer not in (ARTICLE, DOUBTED)):
        return DROPPED
    role, marked = outer, False
    if name in ("article", "main"):
        role = DOUBTED if outer in (BY_CLASS, DOUBTED) else ARTICLE
    if "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if kind == "role":
                if value.strip() in CHROME_ROLES:
                    return DROPPED
                role = ARTICLE if value.strip() in ("main", "article") and role == LOOSE else role
            elif kind == "itemprop":
                role = ARTICLE if value.strip() == "articlebody" and role == LOOSE else role
            elif not CHROME_WORDS.isdisjoint(PART.split(value)):
                marked = True
    if not marked or name in ("html", "body", "main"):
        return role
    if outer in (ARTICLE, DOUBTED):
        return DROPPED
    return DOUBTED if name == "article" else BY_CLASS


def settled(blocks: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """Blocks with the doubtful roles decided by what else the page has."""
    roles = {role for role, _ in blocks}
    doubted = DROPPED if ARTICLE in roles else ARTICLE
    by_class = DROPPED if roles & {ARTICLE, DOUBTED, LOOSE} else LOOSE
    final = {DOUBTED: doubted, BY_CLASS: by_class}
    return [(final.get(role, role), text) for role, text in blocks]


def blocks_of(page: str) -> list[tuple[int, str]]:
    """Role and text of each block with text, in page order."""
    found: list[tuple[int, str]] = []
    texts: tuple[list[str], ...] = ([], [], [], [], [])
    stack: list[tuple[str, int]] = []
    role, at, end = LOOSE, 0, len(page)

    def flush() -> None:
        for kind, parts in enumerate(texts):
            if parts:
                text = " ".join(html_module.unescape("".join(parts)).split())
                parts.clear()
                if text:
                    found.append((kind, text))

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            texts[role].append(page[at:])
            break
        if m.start() > at:
            texts[role].append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        elif name in CELLS:
            texts[role].append(" ")
        if m[1]:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is not None:
                if name not in BLOCK and any(x in BLOCK for x, _ in stack[depth + 1 :]):
                    continue  # an inline end tag doesn't close blocks
                del stack[depth:]
                role = stack[-1][1] if stack else LOOSE
        elif name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = close.start() if close else end
        elif name not in VOID:
            if name in SELF_CLOSING:
                depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
                if depth is not None and not any(x in BLOCK and x not in SELF_CLOSING for x, _ in stack[depth + 1 :]):
                    del stack[depth:]
                    role = stack[-1][1] if stack else LOOSE
            if not (m[3] or "").rstrip().endswith("/") or name in BLOCK:
                role = role_of(name, m[3] or "", role)
                stack.append((name, role))
    flush()
    return settled(found)


def stream_of(blocks: list[tuple[int, str]]) -> list[str]:
    """The tokens of all blocks; a line feed ends a block."""
    return [t for _, text in blocks for t in (*text.split(), "\n")]


def loose_spans(blocks: list[tuple[int, str]]) -> list[int]:
    """Where the loose blocks start and end in the stream of a page."""
    spans, at = [], 0
    for role, text in blocks:
        n = len(text.split())
        if role == LOOSE:
            spans += [at, at + n]
        at += n + 1
    return spans


def packed(tokens: list[str]) -> bytes:
    """The lower 24 bits of each token's hash, three bytes a token."""
    digest = xxhash.xxh32_intdigest
    found = np.array([digest(t) for t in tokens], "<u4")
    return found.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def prefix_ranks(tokens: np.ndarray, k: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``k`` tokens, by doubling the tokens compared.

    The last doubling overlaps, so that exactly ``k`` tokens count; suffixes shorter than that come first.
    """
    n = len(tokens)
    rank, known = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while known < k:
        step = min(known, k - known)
        later = np.zeros(n, np.int64)
        later[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + later, return_inverse=True)[1].astype(np.int64)
        known += step
    return rank


def repeated_starts(streams: list[np.ndarray], pages: list[int], min_tokens: int) -> list[np.ndarray]:
    """For each stream, where windows of ``min_tokens`` start that occur on distinct pages."""
    lengths = np.array([len(s) for s in streams])
    if len(set(pages)) < 2 or not lengths.sum():
        return [np.zeros(0, np.int64)] * len(streams)
    ends = np.cumsum(lengths + 1)
    # A separator of its own behind each stream keeps substrings inside pages.
    ids = np.unique(np.concatenate(streams), return_inverse=True)[1]
    joined = np.full(ends[-1], -1, np.int64)
    joined[np.delete(np.arange(ends[-1]), ends - 1)] = ids
    joined[ends - 1] = ids.max(initial=0) + 1 + np.arange(len(ends))
    rank = prefix_ranks(joined, min_tokens)
    order = np.argsort(rank, kind="stable")
    groups = np.concatenate([[0], np.flatnonzero(np.diff(rank[order])) + 1])
    stream_at = np.repeat(np.arange(len(streams)), lengths + 1)
    owner = np.array(pages, np.int64)[stream_at[order]]
    distinct = np.minimum.reduceat(owner, groups) != np.maximum.reduceat(owner, groups)
    # Equal ranks of suffixes that reach into a separator mean the same suffix, as separators differ.
    found = np.sort(order[np.repeat(distinct, np.diff(np.append(groups, len(order))))])
    begins = ends - lengths - 1
    cuts = np.searchsorted(found, [*begins, ends[-1]])
    return [found[x:y] - b for x, y, b in zip(cuts, cuts[1:], begins)]


def window_hashes(stream: np.ndarray, min_tokens: int) -> np.ndarray:
    """A hash of each window of ``min_tokens`` tokens."""
    n = len(stream) - min_tokens + 1
    total = np.zeros(max(0, n), np.uint64)
    for k in range(min_tokens if n > 0 else 0):
        total = (total ^ stream[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return total.view(np.int64)


def covered(starts: np.ndarray, n: int, min_tokens: int) -> np.ndarray:
    """Which of ``n`` tokens lie in one of the windows."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + min_tokens, n), -1)
    return np.cumsum(edge)[:n] > 0


def with_key(pages: DataFrame, ident: str) -> DataFrame:
    """``key`` (a hash of the row), ``page_id, url, html``."""
    plain = pages.select(
        F.col(ident).alias("page_id"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html")
    )
    return plain.select(F.xxhash64("page_id", "url", "html").alias("key"), "*")


def host_streams(keyed: DataFrame) -> DataFrame:
    """``key, host, tokens, loose, stream`` of each row: where loose text lies, and the tokens' hashes, packed."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                blocks = [blocks_of(x) for x in part.column(2).to_pylist()]
                found = [packed(stream_of(x)) for x in blocks]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(x) // 3 for x in found], pa.int64()),
                        pa.array([loose_spans(x) for x in blocks], pa.list_(pa.int32())),
                        pa.array([packer.compress(x) for x in found], pa.binary()),
                    ],
                    names=["key", "host", "tokens", "loose", "stream"],
                )

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    read = keyed.select("key", host.alias("host"), "html")
    return materialize(read.mapInArrow(mapped, "key long, host string, tokens long, loose array<int>, stream binary"), "streams")


def unpacked(stream: bytes) -> np.ndarray:
    three = np.frombuffer(zstandard.ZstdDecompressor().decompress(stream), np.uint8).reshape(-1, 3)
    four = np.zeros((len(three), 4), np.uint8)
    four[:, :3] = three
    return four.view("<u4").ravel()


def inside(starts: np.ndarray, spans: list[int], min_tokens: int) -> np.ndarray:
    """Those starts whose window meets one of the spans."""
    begins, ends = np.array(spans[::2], np.int64), np.array(spans[1::2], np.int64)
    at = np.searchsorted(ends, starts, side="right")
    some = at < len(begins)
    some[some] = begins[at[some]] < starts[some] + min_tokens
    return starts[some]


def boilerplate_starts(streams: DataFrame, min_tokens: int, shard_tokens: int) -> DataFrame:
    """``key, starts``: where the windows begin that meet loose text and that other pages of the host repeat."""
    sizes = streams.groupBy("host").agg(F.sum(F.col("tokens") + 1).alias("tokens"))
    # At rest, so that its measured size decides how it meets the streams, which need not move for it.
    shards = materialize(sizes.select("host", F.ceil(F.col("tokens") / shard_tokens).cast("int").alias("shards")), "hosts")
    dealt = (
        streams.join(shards, "host")
        .withColumn("shard", F.pmod("key", "shards").cast("int"))
        .select("host", "shard", "key", "loose", "stream", (F.col("shards") > 1).alias("more"))
        .repartition("host", "shard")
        .sortWithinPartitions("host", "shard", "key")
    )

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for run in shard_runs(batches):
            pages = [unpacked(r["stream"]) for r in run] if any(r["loose"] for r in run) else []
            local = repeated_starts(pages, [r["key"] for r in run], min_tokens)
            rows = []
            for r, stream, starts in zip(run, pages, local):
                if not r["loose"]:
                    continue
                every = inside(np.arange(max(0, len(stream) - min_tokens + 1)), r["loose"], min_tokens)
                known = np.intersect1d(every, starts, assume_unique=True)
                # Loose windows that this shard does not repeat may be found in another one.
                asked = np.setdiff1d(every, known, assume_unique=True) if r["more"] else every[:0]
                windows = window_hashes(stream, min_tokens)[asked]
                rows.append((r["host"], r["key"], known.tolist(), windows.tolist(), asked.tolist()))
            for a in range(0, len(rows), 512):
                columns = list(zip(*rows[a : a + 512]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["host", "key", "starts", "windows", "places"]
                )

    shape = "host string, key long, starts array<int>, windows array<long>, places array<int>"
    found = materialize(dealt.mapInArrow(searched, shape), "suffixes")
    asked = found.select("host", "key", F.explode(F.arrays_zip("windows", "places")).alias("w")).select(
        "host", "key", F.col("w.windows").alias("window"), F.col("w.places").alias("place")
    )
    # Every page of a host in shards is a witness; windows that nobody asks for end before the shuffle
    # as long as the questions are few enough to be sent to the tasks.
    cut_hosts = asked.select("host").distinct()
    witnesses = windows_of(streams.join(cut_hosts, "host", "left_semi"), min_tokens)
    wanted = witnesses.join(asked.select("host", "window").distinct(), ["host", "window"], "left_semi")
    shared = wanted.groupBy("host", "window").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    across = asked.join(shared.select("host", "window"), ["host", "window"])
    across = across.groupBy("key").agg(F.collect_set("place").alias("more"))
    every = F.concat("starts", F.coalesce("more", F.array().cast("array<int>")))
    both = found.select("key", "starts").join(across, "key", "left")
    # One row per key: repeated rows, or keys of two pages should they ever collide.
    return both.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list(every))).alias("starts")).where("size(starts) > 0")


def windows_of(streams: DataFrame, min_tokens: int) -> DataFrame:
    """``host, key, window``: the distinct windows of each page."""

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = np.unique(window_hashes(unpacked(batch.column(2)[i].as_py()), min_tokens))
                at = pa.array(np.zeros(len(found), np.int64))
                cells = [batch.column(0).slice(i, 1).take(at), batch.column(1).slice(i, 1).take(at), pa.array(found)]
                yield pa.RecordBatch.from_arrays(cells, names=["host", "key", "window"])

    return streams.select("host", "key", "stream").mapInArrow(mapped, "host string, key long, window long")


def shard_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The pages of each (host, shard) in a sorted stream of batches."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["host"], row["shard"]) != (held[0]["host"], held[0]["shard"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def main_text(page: str, starts: np.ndarray, min_tokens: int) -> tuple[str, int]:
    """The text of one page, given where repeated windows start in its stream, and how many loose tokens they cover."""
    blocks = blocks_of(page)
    hidden = covered(starts, len(stream_of(blocks)), min_tokens)
    spans, at = [], 0
    for role, text in blocks:
        tokens = text.split()
        spans.append((role, text, tokens, hidden[at : at + len(tokens)]))
        at += len(tokens) + 1
    kept, n_hidden = [], 0
    for role, text, tokens, own in spans:
        if role == ARTICLE:
            kept.append(text)
        elif role == LOOSE:
            n_hidden += int(own.sum())
            edges = np.flatnonzero(np.diff(np.concatenate([[True], own, [True]])))
            unique = [t for a, b in zip(edges[::2], edges[1::2]) for t in tokens[a:b]]
            if unique:
                kept.append(" ".join(unique))
    return "\n".join(kept), n_hidden


def extract_text(
    pages: DataFrame, ident: str = "page_id", min_tokens: int = MIN_TOKENS, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """``page_id, url, text, n_chars, n_boilerplate`` of every page."""
    keyed = with_key(pages, ident)
    starts = materialize(boilerplate_starts(host_streams(keyed), min_tokens, shard_tokens), "boilerplate")
    kind = pages.schema[ident].dataType
    arrow_kind = to_arrow_type(kind)

    # Reading the pages a second time costs less than keeping their text beside the streams.
    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists = part.column(3).to_pylist()
                found = [
                    main_text(page, np.array(at or [], np.int64), min_tokens)
                    for page, at in zip(part.column(2).to_pylist(), lists)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(arrow_kind), part.column(1),
                        pa.array([t for t, _ in found], pa.string()),
                        pa.array([len(t) for t, _ in found], pa.int64()),
                        pa.array([n for _, n in found], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_boilerplate"],
                )

    met = keyed.join(starts, "key", "left").select("page_id", "url", "html", "starts")
    return met.mapInArrow(
        parsed, f"page_id {kind.simpleString()}, url string, text string, n_chars long, n_boilerplate long"
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
