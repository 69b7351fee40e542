import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import ODD_ROWS, no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from stargauge.llm import spelling as S
from stargauge.llm.common import table

FOLDER = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, noise=199):
    found = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if noise and h % noise == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 6:
                found[word] += 1
    return found


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(counts):
    words = {w: n for w, n in counts.items() if n >= 5}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def result(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    want = plain_variants(plain_counts(rows))
    assert result(S.op13_spelling(spark, FOLDER)) == want and len(want) > 100


def test_chains_of_forms_and_ties(spark):
    counts = {
        "colours": 6, "colour": 40, "colors": 6, "coloor": 200, "ccloor": 1100, "bcloor": 1100, "acloor": 9000,
        "größer": 30, "grösser": 5, "grßer": 6, "größes": 6, "aaaaaa": 50, "aaaaab": 50, "aaaaaaa": 250, "lonely": 5,
    }
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = S.add_roots(S.spelling_forms(words)).select("word", "form", "root", "n", "n_near", "form_n")
    assert result(got) == plain_variants(counts)


def test_dense_words(spark):
    draw = random.Random(4)
    counts = {"".join(draw.choices("abcé", k=draw.choice([6, 7, 8]))): draw.choice([5, 30, 200]) for _ in range(700)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    for symbols in (1, 3, 8):
        got = S.add_roots(S.spelling_forms(words, symbols=symbols)).select("word", "form", "root", "n", "n_near", "form_n")
        assert result(got) == plain_variants(counts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeé", min_size=1, max_size=9), st.integers(1, 5))
def test_neighbourhood_is_every_edit(word, symbols):
    letters = S.letters_of([word], symbols)
    reduced = letters[0].tolist()
    alphabet = range(1, symbols + 1)
    edits = [reduced, *(reduced[:i] + reduced[i + 1 :] for i in range(len(reduced)))]
    edits += [reduced[:i] + [a] + reduced[i + 1 :] for i in range(len(reduced)) for a in alphabet]
    edits += [reduced[:i] + [a] + reduced[i:] for i in range(len(reduced) + 1) for a in alphabet]
    want = {sum(c * pow(S.BASE, i, 1 << 64) for i, c in enumerate(e)) % (1 << 64) for e in edits}
    assert set(S.neighbourhood(letters, symbols)[0].tolist()) == want


def test_counts_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "WORDS_AT_ONCE", 3)
    rows = [(r[0], r[1]) for r in ODD_ROWS] + [(i, "ABCDEFGH Übermaß, ×÷×÷×÷ x2longword") for i in range(400)]
    extra = spark.createDataFrame(rows[len(ODD_ROWS) :], "doc_id long, text string")
    docs = odd_documents(spark).unionByName(extra, allowMissingColumns=True)
    want = plain_counts(rows)
    assert dict((r["word"], r["n"]) for r in S.word_counts(docs).collect()) == want
    assert result(S.spelling_variants(docs)) == plain_variants(want)
    assert S.spelling_variants(no_documents(spark)).collect() == []


def test_letters_share_few_symbols():
    letters = S.letters_of(["abcdefghijklmnopqrstuvwxyz"], S.SYMBOLS)[0]
    assert set(letters.tolist()) == set(range(1, S.SYMBOLS + 1))
    assert np.bincount(letters.astype(int)).max() <= 8
