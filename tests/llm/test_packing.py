import random
import zlib

import numpy as np
import pytest
from helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from stargauge.llm.packing import WordEncoder, pack, tail_windows, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_encode_like_whole_texts(tokenizer):
    draw = random.Random(2)
    signs = "aAbBéÉßſİıΣςσ'’`.,!?;:_- \n\t ̱́<|>1²½日क्ष😀\x1c"
    texts = ["it's The.END, don't I'LL'S x'rev", "<|endoftext|>. a<|startoftext|>b", "H̱x Ångstrom U.S.A.", "", "  \n"]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randint(1, 40))) for _ in range(500)]
    encoder = WordEncoder(tokenizer_path())
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want
    encoder.direct = False
    encoder.memo.clear()
    assert encoder.encode(texts) == want
    assert encoder.encode([None]) == [b""]


def check_pieces(rows, texts, tokenizer, window):
    """Each id of each text in one piece; windows without gaps; nothing padded."""
    sequences, by_doc = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for ident, pieces in by_doc.items():
        ids, at = np.array(ids_of(tokenizer, texts[ident]), "<u4"), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end == window or (end < window and end & (end - 1) == 0)


def corpus(n=60):
    draw = random.Random(8)
    vocabulary = "some words of a small corpus, été größe ciónasta. The END!".split()
    return [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 150))), "hot" if i % 3 else f"s{i % 5}") for i in range(n)]


@pytest.mark.parametrize(("window", "quantum"), [(64, 16), (32, 32), (128, 5)])
def test_every_token_once(spark, tokenizer, window, quantum):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    check_pieces(pack(docs, window=window, quantum=quantum).collect(), {i: t for i, t, _ in rows}, tokenizer, window)


def test_windows_hold_the_mixture(spark):
    rows = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    window, quantum = 256, 16
    found = pack(docs, window=window, quantum=quantum).collect()
    total = sum(r["length"] for r in found)
    for source in {s for _, _, s in rows}:
        share = sum(r["length"] for r in found if r["source"] == source) / total
        served = 0
        for k in range(total // window):
            served += sum(r["length"] for r in found if r["source"] == source and r["sequence_id"] == k)
            # What is owed carries over: the sum stays within some quanta of the target.
            assert abs(served - share * window * (k + 1)) <= 3 * quantum


def test_given_targets_hold_until_a_queue_is_dry(spark):
    text = "word " * 400
    docs = spark.createDataFrame([(i, text, "ab"[i % 2]) for i in range(8)], "doc_id long, text string, source string")
    found = pack(docs, targets={"a": 3.0, "b": 1.0}, window=128, quantum=16).collect()
    first = [r for r in found if r["sequence_id"] < 10]
    a = sum(r["length"] for r in first if r["source"] == "a")
    assert abs(a - 0.75 * 1280) <= 48
    assert sum(r["length"] for r in found if r["source"] == "b") == 4 * 401


def test_tail_is_cut_into_powers_of_two():
    assert tail_windows(2048 * 3 + 13, 2048) == [(6144, 8), (6152, 4), (6156, 1)]
    assert tail_windows(4096, 2048) == [] == tail_windows(0, 2048)


def test_odd_rows_and_empty_table(spark, tokenizer):
    docs = odd_documents(spark)
    found = pack(docs, window=64, quantum=16).collect()
    want = sorted(len(ids_of(tokenizer, r["text"])) for r in docs.select("text").collect())
    assert sum(r["length"] for r in found) == sum(want)
    assert sum(1 for r in found if r["doc_id"] == 1) == 1
    assert pack(no_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        pack(docs, window=16, quantum=17)
