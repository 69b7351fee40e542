import numpy as np
from helpers import no_documents, odd_documents

from stargauge.llm.byte_cnn import ByteCnn, add_quality, fit_quality
from stargauge.llm.common import remainder, table

FOLDER = "/root/testdata/sf0.01"


def plain_score(model, data):
    """Every chunk of two hops, every position, every filter, one by one."""
    w, hop = model.weights, model.hop
    n_hops = (len(data) + model.width - 2) // hop + 1
    padded = data.ljust(n_hops * hop + model.width, b"\0")
    response = np.array(
        [sum(w["filters"][k][padded[i + k]].astype(float) for k in range(model.width)) for i in range(n_hops * hop - model.width + 1)]
    )
    chunks = [response[c * hop : (c + 2) * hop] for c in range(max(1, n_hops - 1))]
    hidden = np.array([np.maximum(w["hidden"] @ (c.max(axis=0) + w["filter_bias"]) + w["hidden_bias"], 0) for c in chunks])
    logit = np.concatenate([hidden.max(axis=0), hidden.mean(axis=0)]) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-logit))


def test_scores_match_a_plain_network():
    model = ByteCnn(hop=16)
    model.initial(4)
    texts = [b"", b"a", b"x" * 11, b"y" * 12, bytes(range(1, 256)) * 3, "größe".encode() * 9]
    assert np.allclose(model.scorer()(texts), [plain_score(model, t) for t in texts], atol=1e-5)


def test_gradients_match_differences():
    model = ByteCnn(hop=16, n_filters=3, n_hidden=4)
    model.initial(2)
    texts, labels, weight = [b"some text, longer than one hop", b"!!", b"zz" * 30], np.array([1, 0, 1.0]), np.array([1, 2, 0.5])

    def loss():
        p = np.array([plain_score(model, t) for t in texts])
        return -(weight * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum()

    found = model.gradients(texts, labels, weight)
    for name in ("out", "hidden", "out_bias", "filters"):
        flat = model.weights[name].astype(np.float64)
        model.weights[name] = flat
        at = np.unravel_index(np.argmax(np.abs(found[name])), flat.shape)
        step = 1e-4
        flat[at] += step
        up = loss()
        flat[at] -= 2 * step
        slope = (up - loss()) / (2 * step)
        flat[at] += step
        assert abs(slope - found[name][at]) < 0.02 * max(1, abs(slope))


def test_held_out_accuracy(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = fit_quality(docs.where(remainder("doc_id", 4) != 2), labels.where(remainder("doc_id", 4) != 2))
    held = add_quality(docs.where(remainder("doc_id", 4) == 2), model).join(labels, "doc_id").select("quality_score", "quality").collect()
    right = [(r["quality_score"] >= 0.7) == (r["quality"] == 1) for r in held]
    assert len(right) > 50 and np.mean(right) > 0.9


def test_odd_rows_one_class_and_empty_table(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 0), (5, 1, 0), (4, None, None), (None, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    model = fit_quality(docs, labels, epochs=1)
    out = add_quality(docs, model, into="score")
    assert set(out.columns) == set(docs.columns)
    rows = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert all(0 <= x <= 1 for x in rows.values()) and rows[1, None] == rows[2, ""]
    ones = fit_quality(docs, labels.where("quality = 1"))
    assert {r["quality_score"] for r in add_quality(docs, ones).collect()} == {1.0}
    nothing = fit_quality(no_documents(spark), labels.limit(0))
    assert nothing.prior == 0.5 and add_quality(no_documents(spark), model).count() == 0
