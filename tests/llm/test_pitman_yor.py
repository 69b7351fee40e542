import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import no_documents, odd_documents
from pyspark.sql import functions as F

from stargauge.llm import pitman_yor
from stargauge.llm.common import remainder, table
from stargauge.llm.pitman_yor import SAMPLES, STRENGTH, Model, Part, frequent_words, of_kind, packed, score_documents, tokens_of, unpacked


def model_of(spark, texts, parts=1):
    """Each pair's training tokens, tables, and its word's and context's totals, and the model, of a small corpus."""
    rows = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    model = Model(rows, frequent_words(rows)[0], parts)

    def opened(p, messages):
        messages = list(messages)
        part = Part(of_kind(messages, pitman_yor.BLOCK), parts)
        if part.chunks:
            (totals,) = part.from_owners(dict(of_kind(messages, pitman_yor.COUNTED)))
            roots, of_context = part.from_owners(dict(of_kind(messages, pitman_yor.TOTALS)))
            words, contexts, counts, _ = part.pairs()
            (tables,) = unpacked(of_kind(messages, pitman_yor.SEATED)[0][1])
            for k, (w, c) in enumerate(zip(words, contexts)):
                yield (
                    int(part.keys[w]), int(part.keys[c]), int(counts[k]), tables[:, k].tolist(), int(totals[w]), int(totals[c]),
                    roots[:, w].tolist(), of_context[:, c].tolist(),
                )

    steps = model.together(model.tokens, model.counted, model.seated, model.returned)
    assert steps.getNumPartitions() == parts
    return steps.mapPartitionsWithIndex(opened).collect(), model.restaurants


def sentences(n=300):
    draw = random.Random(3)
    nouns, verbs = ["cat", "dog", "house", "tree"], ["runs", "falls", "burns"]
    return [" ".join(x for _ in range(draw.randint(1, 6)) for x in ("the", draw.choice(nouns), draw.choice(verbs))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [1 << 12, 20])
def test_probabilities_of_each_context_sum_to_one(spark, monkeypatch, frequent):
    monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
    texts = sentences(80) + ["one rare word"]
    pairs, model = model_of(spark, texts, parts=3)
    words = Counter(w for t in texts for w in tokens_of(t))
    follow = Counter(pair for t in texts for pair in zip([b"", *tokens_of(t)], tokens_of(t)))
    digest = pitman_yor.xxhash.xxh64_intdigest
    assert model.n_words == len(words) and model.n_tokens == sum(words.values())
    assert {(w, c): n for w, c, n, *_ in pairs} == {(digest(w), digest(c)): n for (c, w), n in follow.items()}
    by_hash = {digest(w): n for w, n in words.items()}
    for w, c, n, tables, n_word, n_context, roots, of_context in pairs:
        assert (n_word, n_context) == (by_hash[w], by_hash[c]) and all(1 <= t <= n for t in tables)
        assert roots == np.sum([x[3] for x in pairs if x[0] == w], axis=0).tolist()
        assert of_context == np.sum([x[3] for x in pairs if x[1] == c], axis=0).tolist()
    for s in range(SAMPLES):
        roots = {w: r[s] for w, *_, r, _ in pairs}
        assert sum(roots.values()) == model.tables[s]
        known = (model.tables[s] - model.root_discount * model.n_words) / (STRENGTH + model.tables[s])
        unknown = (STRENGTH + model.root_discount * model.n_words) / (STRENGTH + model.tables[s])
        assert math.isclose(known + unknown, 1)
        for context in {x[1] for x in pairs}:
            mine = [x for x in pairs if x[1] == context]
            held = sum(x[2] - model.discount * x[3][s] for x in mine)
            mass = STRENGTH + model.discount * mine[0][7][s]
            assert math.isclose((held + mass) / (STRENGTH + mine[0][5]), 1)


def test_context_words_inform_the_next(spark):
    rows = [(i, False, t) for i, t in enumerate(sentences())]
    r = score_documents(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")).agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.96 * r[1]  # both negative


def test_rare_words_are_contexts_too(spark):
    draw = random.Random(5)
    rows = [(i, i >= 600, " ".join(f"a{k} b{k}" for k in draw.sample(range(400), 8))) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    r = score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.65 * r[1]  # the second word of each pair is known from the first; both are far below 1 in 256


def brute_base(rows):
    counts = Counter(w for _, held, t in rows if not held for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(tokens_of(t)), sum(counts[w] > 0 for w in tokens_of(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens_of(t)))
        for i, _, t in rows
    }


@pytest.mark.parametrize("chunk_tokens", [2_000_000, 50])
def test_base_scores_match_a_plain_count(spark, monkeypatch, chunk_tokens):
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", chunk_tokens)
    draw = random.Random(1)
    rows = [(i, i % 7 == 2, t) for i, t in enumerate(sentences(90))] + [(500, True, "Never SEEN words"), (501, False, None), (502, True, "")]
    rows += [(600 + i, False, " ".join(str(draw.randrange(400)) for _ in range(20))) for i in range(20)]
    got = {r["doc_id"]: r for r in score_documents(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)).collect()}
    for i, (n, known, total, base) in brute_base(rows).items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0 and r["perplexity"] >= 1
    assert got[500]["n_known"] == 1


def test_held_out_texts_score_better_than_the_base(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "text")
    r = score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 0.95 * r[1]


def test_odd_rows_no_training_and_empty_table(spark):
    docs = odd_documents(spark).select("doc_id", F.lit(False).alias("held_out"), "text")
    got = score_documents(docs).collect()
    assert len(got) == docs.count() and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert len({r["score"] for r in got if r["doc_id"] in (5, 6)}) == 1
    untrained = score_documents(docs.withColumn("held_out", F.lit(True))).collect()
    assert {r["n_known"] for r in untrained} == {0} and {r["score"] for r in untrained} == {0.0}
    assert score_documents(docs.limit(0)).count() == 0
    assert score_documents(no_documents(spark).select("doc_id", F.lit(False).alias("held_out"), "text")).count() == 0


def test_packed_arrays_come_back():
    a, b = np.arange(5, dtype=np.uint32), np.zeros((2, 0))
    x, y = unpacked(packed(a, b))
    assert (x == a).all() and y.shape == b.shape
