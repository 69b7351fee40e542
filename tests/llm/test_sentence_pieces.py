import itertools
import pickle
import random
from pathlib import Path

import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from helpers import LONG, no_documents, odd_documents
from pyspark.sql import functions as F

from stargauge.llm import sentence_pieces
from stargauge.llm.sentence_pieces import (
    COARSE_WORDS, FINE_WORDS, Vocabulary, decode, distinct_words, encode_documents, encode_words, load, op2_sentence_pieces,
)
from stargauge.session import shared_folder


@pytest.fixture(scope="module")
def vocabulary():
    return load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_documents_encode_like_the_library(spark, vocabulary, library):
    draw = random.Random(7)
    signs = ["a", "the", " ", "  ", "T", "ing", "é", "ß", "日本", "😀", "1", "23", "²", "².", "\n", "\t", "...", "don't", "▁", "x_y", "क्ष"]
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randint(1, 25)))) for i in range(150)]
    rows += [(1000, "Hello  world. the thnterble\nx"), (1001, "internationalisation" * 12)]
    got = {r["doc_id"]: r["ids"] for r in encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary).collect()}
    assert got == {i: library.encode(t) for i, t in rows}


def test_ids_decode_to_the_words(spark, vocabulary):
    rows = [(w,) for w in ("▁the", "größe", "😀", "▁▁", "日本語", ".\n\t", "a" * 3000, "².")]
    encoded = encode_words(spark.createDataFrame(rows, "word string"), vocabulary)
    assert {r["word"]: r["text"] for r in decode(encoded, vocabulary).collect()} == {w: w for (w,) in rows}


def test_viterbi_takes_the_best_path(spark):
    pieces = {"a": -1.0, "b": -1.2, "ab": -1.9, "ba": -2.5, "aba": -3.3, "bb": -1.1, "abab": -3.7, "c": -4.0}
    toy = Vocabulary(tuple((300 + i, p, s) for i, (p, s) in enumerate(pieces.items())), tuple(range(256)), False)
    words = ["".join(w) for n in range(1, 7) for w in itertools.islice(itertools.product("abc", repeat=n), 0, 200, 3)] + ["aéb"]
    by_id = {300 + i: p for i, p in enumerate(pieces)}

    def best(word):
        if not word:
            return 0.0
        return max(pieces[p] + best(word[len(p) :]) for p in pieces if word.startswith(p))

    got = {r["word"]: r["ids"] for r in encode_words(spark.createDataFrame([(w,) for w in words], "word string"), toy).collect()}
    for word in words[:-1]:
        chosen = [by_id[i] for i in got[word]]
        assert "".join(chosen) == word and abs(sum(pieces[p] for p in chosen) - best(word)) < 1e-9
    assert got["aéb"] == [300, 0xC3, 0xA9, 301]


def test_words_are_fine_only_where_no_piece_mixes(vocabulary):
    assert vocabulary.bpe and vocabulary.words == FINE_WORDS
    assert Vocabulary(((1, "a.", -1.0),), tuple(range(256)), True).words == COARSE_WORDS
    assert Vocabulary(((1, "12", -1.0),), tuple(range(256)), True).words == COARSE_WORDS


def test_odd_rows_and_empty_table(spark, vocabulary, library):
    docs = odd_documents(spark)
    got = encode_documents(docs, vocabulary).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r["ids"] for r in got if r["doc_id"] is not None}
    assert by_id[1] == by_id[2] == [] and by_id[5] == by_id[6] == library.encode("same text here, twice")
    assert by_id[4] == library.encode(LONG)
    assert encode_documents(no_documents(spark), vocabulary).count() == 0
    assert distinct_words(docs, vocabulary).agg(F.sum("n")).first()[0] > 0


def test_query_encodes_and_decodes_every_document(spark, library, monkeypatch):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for frequent in (1 << 16, 50):
        monkeypatch.setattr("stargauge.llm.sentence_pieces.FREQUENT", frequent)
        got = op2_sentence_pieces(spark, folder).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(texts)
        for r in got:
            assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_pieces"] == len(r["ids"])
            assert r["text"] == texts[r["doc_id"]].replace("▁", " ")


def test_words_without_blanks_of_any_length(spark, vocabulary, library):
    draw = random.Random(3)
    rows = [
        (0, "".join(draw.choices("abcdefghij", k=100_000))), (1, "日本語" * 20_000), (2, "😀" * 300 + "a" * 70), (3, "short words"),
        (4, "-" * 5000), (5, " " * 500 + "x"),
    ]
    got = {r["doc_id"]: r for r in encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary).collect()}
    for i, text in rows:
        assert got[i]["ids"] == library.encode(text) and got[i]["text"] == text


def test_long_words_take_the_best_path(spark):
    toy = Vocabulary(((300, "a", -1.0), (301, "aa", -1.5), (302, "b", -3.0)), tuple(range(256)), False)
    word = "a" * 81 + "b"
    (got,) = encode_words(spark.createDataFrame([(word,)], "word string"), toy).collect()
    assert sorted(got["ids"]) == [300] + [301] * 40 + [302]


def kept_files(spark):
    folder = Path(shared_folder(spark).removeprefix("file://"), "stargauge", spark.sparkContext.applicationId)
    return {p for p in folder.rglob("*") if p.is_file()}


def test_documents_move_once_and_leave_no_tables(spark, vocabulary):
    folder = "/root/testdata/sf0.01"
    before = kept_files(spark)
    done = encode_documents(spark.read.parquet(f"{folder}/documents.parquet"), vocabulary)
    assert done.selectExpr("count(ids)", "sum(length(text))").first()[0] == 1000
    assert kept_files(spark) == before


def test_messages_are_smaller_than_the_input(spark, vocabulary):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = spark.read.parquet(path).select("doc_id", sentence_pieces.marked(F.col("text")).alias("text")).rdd.coalesce(1)
    shared = spark.sparkContext.broadcast(sentence_pieces.piece_table(vocabulary))
    cut = rows.mapPartitions(sentence_pieces.drafts(lambda: shared.value, 1, 4, sentence_pieces.FREQUENT)).partitionBy(4).cache()
    answered = cut.mapPartitions(sentence_pieces.answers(lambda: shared.value))
    sent = [pickle.loads(m) for _, m in cut.union(answered).collect()]
    assert sum(len(pickle.dumps(m, 5)) for m in sent) < 1.5 * Path(path).stat().st_size
    # A word is asked for once in a chunk, and its ids come back once.
    asked = [len(sentence_pieces.unpacked(m[5])) for m in sent if m[0] == sentence_pieces.ASKED]
    got = [len(sentence_pieces.unpacked(m[3])) for m in sent if m[0] == sentence_pieces.ANSWER]
    assert sum(asked) == sum(got) == distinct_words(spark.read.parquet(path), vocabulary).count()


def test_words_are_cut_as_by_the_pattern(spark, vocabulary):
    draw = random.Random(5)
    signs = ["a", "b", "é", "ß", "日", "😀", "1", "٣", "²", ".", "\n", "\t", " ", "  ", "▁", "्", "क"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    coarse = Vocabulary(((1, "a.", -1.0),), tuple(range(2, 258)), True)
    for v in (vocabulary, coarse):
        text = sentence_pieces.marked(F.col("text"))
        found = F.regexp_extract_all(text, F.lit(v.words), F.lit(0)).alias("found")
        rows = spark.createDataFrame([(t,) for t in texts], "text string").select(text.alias("text"), found).collect()
        words, counts = sentence_pieces.cut_words(pa.array([r["text"] for r in rows]), sentence_pieces.piece_table(v).kinds)
        assert words.to_pylist() == [w for r in rows if r["text"] for w in r["found"]]
        assert counts.tolist() == [len(r["found"]) if r["text"] else 0 for r in rows]


@pytest.mark.parametrize("size", [1, 7, 60])
def test_small_chunks_parts_and_batches_give_the_same(spark, vocabulary, library, monkeypatch, size):
    for name in ("CUT_LETTERS", "CHUNK_BYTES", "PART_BYTES", "LATTICE_LETTERS", "FILLED_WORDS"):
        monkeypatch.setattr(f"stargauge.llm.sentence_pieces.{name}", size * 10 if name == "PART_BYTES" else size)
    rows = [(f"d{i % 20}", t) for i, t in enumerate(["the same words", "", None, "Größe 😀 12", "the words " * 9, "x" * 70] * 4)]
    got = encode_documents(spark.createDataFrame(rows, "name string, body string"), vocabulary, "name", "body").collect()
    want = sorted((i, library.encode(t or ""), t or "") for i, t in rows)
    assert sorted((r["doc_id"], r["ids"], r["text"]) for r in got) == want


def test_empty_texts_alone_and_broken_bytes(spark, vocabulary, library):
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["ids"], r["text"]) for r in encode_documents(empty, vocabulary).collect()) == [(1, [], ""), (2, [], "")]
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(unhex('61FF20C362') AS string)").alias("text"))
    (got,) = encode_documents(broken, vocabulary).collect()
    assert got["ids"] == library.encode(got["text"]) and got["text"] == "a� �b"


def test_merges_go_by_score_then_place(monkeypatch):
    draw = random.Random(11)
    parts = ["a", "b", "c"] + ["".join(draw.choices("abc", k=draw.randint(2, 5))) for _ in range(40)]
    toy = Vocabulary(tuple((300 + i, p, -float(draw.randint(0, 12))) for i, p in enumerate(dict.fromkeys(parts))), tuple(range(256)), True)
    by_piece = {p: (i, s) for i, p, s in toy.pieces}

    def greedy(word):
        cut = list(word)
        while True:
            pairs = [(-by_piece[a + b][1], i) for i, (a, b) in enumerate(zip(cut, cut[1:])) if a + b in by_piece]
            if not pairs:
                return [i for p in cut for i in ([by_piece[p][0]] if p in by_piece else p.encode())]
            _, i = min(pairs)
            cut[i : i + 2] = [cut[i] + cut[i + 1]]

    words = ["".join(draw.choices("abcé", [5, 5, 5, 1], k=draw.randint(1, 40))) for _ in range(300)]
    for short in (64, 10, 0):
        monkeypatch.setattr("stargauge.llm.sentence_pieces.SHORT", short)
        ids, counts = sentence_pieces.encode_column(pa.array(words), sentence_pieces.piece_table(toy))
        ends = list(itertools.accumulate(counts.tolist(), initial=0))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [greedy(w) for w in words]
