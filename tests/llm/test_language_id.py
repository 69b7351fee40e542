import numpy as np
from helpers import no_documents, odd_documents

from stargauge.llm import language_id
from stargauge.llm.common import remainder, table
from stargauge.llm.language_id import LanguageModel, add_language, family_of, fit_languages, gram_indices, letters_of, training_sample

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, FOLDER, "documents")
    model = fit_languages(training_sample(docs.where(remainder("doc_id", 5) != 0), 150))
    assert {p[0] for p in model.pairs} == {"", "germanic", "romance"}
    rows = add_language(docs.where(remainder("doc_id", 5) == 0), model).select("lang", "lang_pred", "lang_score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["lang_score"] <= 1 for r in rows)


def test_margins_match_single_lookups(monkeypatch):
    monkeypatch.setattr(language_id, "BYTES_AT_ONCE", 16)
    draw = np.random.default_rng(1)
    model = LanguageModel(["x", "y"], [("", "a", "b")], draw.normal(size=(3, language_id.TABLE, 1)).astype(np.float32), np.array([0.5]), np.array([1.0]))
    texts = [letters_of(t) for t in ("a", "Several words, and more of them than sixteen bytes", "ÄÖ", "zz" * 40)]
    want = []
    for t in texts:
        rows = gram_indices(np.frombuffer(t, np.uint8))
        want.append(10 * sum(model.weights[k, rows[k], 0].sum() for k in range(3)) / len(rows[0]) + 0.5)
    assert np.allclose(model.margins(texts)[:, 0], want, rtol=1e-4)


def test_what_counts_as_letters():
    assert letters_of(None) == letters_of(" 12 ² ½ _ !") == b"" and letters_of("É1b") == " é b    ".encode()


def test_families():
    assert family_of("pt-BR") == "romance" and family_of("EN") == "germanic" and family_of("tlh") != family_of("vo")


def test_odd_rows_and_missing_classes(spark):
    docs = odd_documents(spark)
    model = fit_languages(training_sample(docs, 100, max_train_bytes=1 << 20))
    out = add_language(docs, model)
    rows = {(r["doc_id"], r["text"]): (r["lang_pred"], r["lang_score"]) for r in out.collect()}
    assert rows[1, None] == rows[2, ""] == rows[7, "12345 67890 !!! ???"] == ("und", 0.0)
    assert {x for x, _ in rows.values()} <= {"und", "en", "de", "xx", "fr"}
    only = add_language(docs, LanguageModel(["en"])).collect()
    assert {r["lang_pred"] for r in only} == {"en", "und"}
    assert {r["lang_pred"] for r in add_language(docs, fit_languages([])).collect()} == {"und"}
    assert add_language(no_documents(spark), model).count() == 0
    assert training_sample(no_documents(spark), 10) == []
