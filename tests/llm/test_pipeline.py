import random

import numpy as np
import pytest
from helpers import no_documents, odd_documents, words
from pyspark.sql import functions as F

import corpus_pipeline
from stargauge.llm.common import table
from stargauge.llm.near_duplicates import add_wide_fingerprints, allowed_bits, link_wide, one_of_each, wide_fingerprint
from stargauge.llm.quality_rules import judge_lines

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, FOLDER, "documents")


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "packing"]


def test_classifier_drops_what_it_rejects(spark, documents):
    kept = corpus_pipeline.quality_classifier(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    ids = {r["doc_id"] for r in kept.collect()}
    labels = table(spark, FOLDER, "labels").collect()
    assert np.mean([(r["doc_id"] in ids) == (r["quality"] == 1) for r in labels]) > 0.8


def test_rules_drop_documents_and_lines(spark, documents):
    kept = corpus_pipeline.quality_rules(spark, documents, FOLDER)
    assert kept.columns == documents.columns and kept.schema == documents.schema
    want = {r["doc_id"]: r["line_rules"]["clean_text"] for r in judge_lines(documents).where("line_rules.kept").collect()}
    got = {r["doc_id"]: r for r in kept.collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def shingles(text, width=5):
    found = words((text or "").encode().lower().decode())
    return frozenset(tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))) if found else frozenset()


def alike(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def test_one_document_of_each_group_stays(spark):
    """Of all pairs of 0.8 or more nine in ten lose a document, and nothing unlike anything else goes."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    holders = {}
    for i, s in sets.items():
        for x in s or ["no words"]:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for some in holders.values() if len(some) < 300 for a in some for b in some if a < b}
    score = {p: alike(sets[p[0]], sets[p[1]]) for p in pairs}
    near = [p for p, s in score.items() if s >= 0.8]
    caught = [p for p in near if not set(p) <= left]
    assert len(near) > 50 and len(caught) >= 0.9 * len(near)
    exact = [p for p, s in score.items() if sets[p[0]] == sets[p[1]] and s == 1]
    partners = {i for p, s in score.items() if s >= 0.4 for i in p}
    assert left >= set(sets) - partners and exact
    assert min(sets) in left


def test_copies_with_small_edits_go(spark):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(4000)]
    rows, edited = [], []
    for i in range(60):
        text = draw.choices(vocabulary, k=300)
        rows.append((i, " ".join(text)))
        for k in range(2):
            other = list(text)
            for at in draw.sample(range(300), 6):
                other[at] = draw.choice(vocabulary)
            edited.append((100 + 10 * i + k, " ".join(other)))
            assert alike(shingles(rows[-1][1]), shingles(edited[-1][1])) > 0.75
    frame = spark.createDataFrame(rows + edited + rows[:5], "doc_id long, text string")
    left = [r["doc_id"] for r in one_of_each(frame).collect()]
    assert len(left) == len(set(left)) and set(left) >= set(range(60)) and len(left) <= 60 + 12


def test_large_groups_are_cut_into_tiles(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(300)]
    frame = add_wide_fingerprints(spark.createDataFrame(rows, "node long, text string")).select("node", "wide")
    edges = link_wide(frame, tile=32).collect()
    assert len(connected_pairs([(r["a"], r["b"]) for r in edges], range(300))) == 1
    assert link_wide(frame.limit(0)).collect() == []


def connected_pairs(edges, nodes):
    root = {n: n for n in nodes}
    for a, b in edges:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[a] = b
    return {n for n in nodes if root[n] == n}


def test_bits_follow_the_similarity():
    assert allowed_bits(1.0, 8) == 0 and 80 < allowed_bits(0.8, 8) < 100 < allowed_bits(0.7, 8)
    x, y = (wide_fingerprint(t) for t in ("a b c d e f g", "A B C D E F G"))
    assert (x == y).all() and not wide_fingerprint(" \n").any() and wide_fingerprint("one two").any()


def test_stages_survive_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() >= 0 and stage(spark, no_documents(spark), FOLDER).count() == 0
        if name != "packing":
            assert set(out.columns) == set(docs.columns)
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER).select("doc_id", "text").collect()
    assert sum(1 for r in kept if r["text"] == "same text here, twice") == 1
    assert sum(1 for r in kept if not (r["text"] or "").strip()) == 1


def test_run_packs_what_the_stages_keep(spark):
    pieces = corpus_pipeline.run(spark, FOLDER)
    per_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert per_doc and all(r["n"] == r["all"] for r in per_doc)
