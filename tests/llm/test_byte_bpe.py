import hashlib
import random

import numpy as np
import pytest
from helpers import ODD_ROWS, no_documents, odd_documents

from stargauge.llm import byte_bpe as B
from stargauge.llm.common import table

FOLDER = "/root/testdata/sf0.001"
TEXT = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding(
        "plain", pat_str=B.split_pattern(), mergeable_ranks=B.read_ranks(B.ranks_path()), special_tokens={}
    )


def ids_of(frame):
    return sorted(((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in frame.collect()), key=str)


def plain_ids(library, rows):
    return sorted(((i, tuple(library.encode_ordinary(x or ""))) for i, x in rows), key=str)


def test_query_equals_the_library(spark, library):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    want = []
    for i, x in rows:
        ids = library.encode_ordinary(x or "")
        data = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in B.op12_byte_bpe(spark, FOLDER).collect()) == sorted(want)


@pytest.mark.parametrize("chunk, overlap", [(200, 100), (64, 40), (1000, 17)])
def test_chunks_are_stitched_like_whole_texts(spark, library, chunk, overlap):
    draw = random.Random(chunk)
    parts = ["the cat's ", "we'll ", "  \n\n ", "été ", "日本語", "12345", " !!! ", "'", "'re", "\t", "😀😀", "word", "a" * 30, " " * 20]
    rows = [(i, "".join(draw.choices(parts, k=draw.choice([1, 20, 300])))) for i in range(60)]
    frame = spark.createDataFrame(rows, TEXT)
    assert ids_of(B.encode(frame, chunk=chunk, overlap=overlap)) == plain_ids(library, rows)


def test_runs_longer_than_an_overlap(spark, library):
    rows = [
        (0, "x" * 5000), (1, "some words, " * 50 + "y" * 1000 + " and more words" * 40), (2, " " * 3000 + "end"),
        (3, "日" * 2000), (4, "ab " * 500 + "-" * 700 + "cd " * 300 + "\n" * 900),
    ]
    frame = spark.createDataFrame(rows, TEXT)
    assert ids_of(B.encode(frame, chunk=256, overlap=64)) == plain_ids(library, rows)


def test_a_stitch_is_a_common_boundary(spark):
    frame = spark.createDataFrame([(0, "some words of a text " * 40)], TEXT)
    encoder = B.encoder_of(B.ranks_path(), B.split_pattern())
    chunks = B.cut(B.texts_of(frame, "doc_id", "text"), 200, 50)
    rows = B.stitches(B.pretokenise(chunks, encoder, 200, 50)).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(len(rows))) and len(rows) > 3 and not any(r["whole"] for r in rows)
    assert all(a["stop"] == b["start"] for a, b in zip(rows, rows[1:])) and rows[-1]["stop"] is None
    data = b"some words of a text " * 40
    assert all(data[r["start"] : r["start"] + 1] in (b" ", b"s") for r in rows)


def test_round_trip_and_odd_rows(spark, library):
    docs = odd_documents(spark)
    rows = [(r[0], r[1]) for r in ODD_ROWS]
    got = B.decode(B.encode(docs, chunk=4096, overlap=256))
    assert ids_of(got.select("doc_id", "ids")) == plain_ids(library, rows)
    decoded = sorted(((r["doc_id"], bytes(r["decoded"]).decode()) for r in got.collect()), key=str)
    assert decoded == sorted(((i, x or "") for i, x in rows), key=str)
    assert B.encode(no_documents(spark)).collect() == []


def test_a_long_text_without_blanks(spark, library):
    rows = [(0, "abcdefghij" * 30_000), (1, "é" * 100_000)]
    frame = spark.createDataFrame(rows, TEXT)
    assert ids_of(B.encode(frame)) == plain_ids(library, rows)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        B.encode(no_documents(spark), chunk=10, overlap=20)
