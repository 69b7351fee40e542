"""Quality classifier: a byte-level convolutional network over overlapping chunks of whole texts.

The text's UTF-8 bytes are cut into chunks of two neighbouring hops, so that consecutive chunks
overlap by half and together cover the document. Learned filters over ``width`` bytes slide over
every position; each chunk keeps a filter's largest response, a small layer turns that into hidden
features, and the largest and the mean of these over all chunks give one probability.

Training uses a bounded sample of labelled rows (``per_class`` rows a class, texts of at most
``max_train_bytes``), with weights that restore the classes' true shares; the bound is the model's
only limit, and scoring reads whole texts.

Defined results: a null text is scored like an empty one; labels that are null are not used; a key
with several labels counts once, with the smallest; without rows of both classes every text gets the
share of label 1 (one half without any label); repeated rows get equal scores; an empty table gives
an empty result. A column that carries the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from stargauge.llm.common import remainder, table

#: Positions whose responses are held at once while scoring.
POSITIONS_AT_ONCE = 1 << 17


@dataclass
class ByteCnn:
    """Weights: ``filters`` (width, 256, f), ``hidden`` (h, f), ``out`` (2h) and their biases."""

    width: int = 6
    n_filters: int = 16
    n_hidden: int = 16
    hop: int = 128
    prior: float = 0.5
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def initial(self, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.weights = {
            "filters": draw.normal(0, 0.3, (self.width, 256, self.n_filters)).astype(np.float32),
            "filter_bias": np.zeros(self.n_filters, np.float32),
            "hidden": draw.normal(0, self.n_filters**-0.5, (self.n_hidden, self.n_filters)).astype(np.float32),
            "hidden_bias": np.zeros(self.n_hidden, np.float32),
            "out": draw.normal(0, 0.1, 2 * self.n_hidden).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }

    def laid_out(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bytes, each text padded by zeros to whole hops that end after its last window; hops per
        text; and the positions whose windows would reach into the next text."""
        hops = np.array([(len(t) + self.width - 2) // self.hop + 1 for t in texts])
        pieces = b"".join(t.ljust(n * self.hop, b"\0") for t, n in zip(texts, hops.tolist()))
        ends = np.cumsum(hops) * self.hop
        crossing = (ends[:, None] - np.arange(self.width - 1, 0, -1)).ravel()
        return np.frombuffer(pieces + bytes(self.width), np.uint8), hops, crossing

    def chunks(self, peaks: np.ndarray, hops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left and right hop of every chunk, and the first chunk of every text."""
        counts = np.maximum(hops - 1, 1)
        starts = np.concatenate([[0], np.cumsum(counts)])
        first_hop = np.concatenate([[0], np.cumsum(hops)])[:-1]
        left = np.arange(starts[-1]) + np.repeat(first_hop - starts[:-1], counts)
        right = left + np.repeat(hops > 1, counts)
        return np.stack([left, right]), starts[:-1]

    def head(self, pooled: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Hidden features of the chunks, their largest and mean per text, and the texts' logits."""
        w = self.weights
        hidden = np.maximum(pooled @ w["hidden"].T + w["hidden_bias"], 0)
        sizes = np.diff(np.append(starts, len(pooled)))
        largest = np.maximum.reduceat(hidden, starts, axis=0)
        mean = np.add.reduceat(hidden, starts, axis=0) / sizes[:, None]
        return hidden, largest, mean, np.hstack([largest, mean]) @ w["out"] + w["out_bias"][0]

    def scorer(self):
        """A function from texts to probabilities; two neighbouring filter bytes share one lookup."""
        if not self.weights:
            return lambda texts: np.full(len(texts), self.prior)
        f = self.weights["filters"]
        pairs = [
            np.ascontiguousarray((f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1))
            for k in range(0, self.width, 2)
        ]

        def peaks_of(data: np.ndarray, n_hops: int, crossing: np.ndarray) -> np.ndarray:
            peaks = np.empty((n_hops, self.n_filters), np.float32)
            step = max(1, POSITIONS_AT_ONCE // self.hop)
            for a in range(0, n_hops, step):
                b = min(n_hops, a + step)
                part = data[a * self.hop : b * self.hop + self.width].astype(np.intp)
                index = part[:-1] * 256 + part[1:]
                n = (b - a) * self.hop
                total = pairs[0].take(index[:n], axis=0)
                for k in range(1, len(pairs)):
                    total += pairs[k].take(index[2 * k : 2 * k + n], axis=0)
                total[crossing[slice(*np.searchsorted(crossing, [a * self.hop, b * self.hop]))] - a * self.hop] = -np.inf
                peaks[a:b] = total.reshape(b - a, self.hop, -1).max(axis=1)
            return peaks + self.weights["filter_bias"]

        def score(texts: list[bytes]) -> np.ndarray:
            data, hops, crossing = self.laid_out(texts)
            peaks = peaks_of(data, int(hops.sum()), crossing)
            (left, right), starts = self.chunks(peaks, hops)
            logits = self.head(np.maximum(peaks[left], peaks[right]), starts)[-1]
            return 1 / (1 + np.exp(-np.clip(logits.astype(np.float64), -30, 30)))

        return score

    def gradients(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss; a filter learns from the positions of its peaks only."""
        w = self.weights
        data, hops, crossing = self.laid_out(texts)
        n = int(hops.sum()) * self.hop
        wide = data.astype(np.intp)
        total = w["filters"][0].take(wide[:n], axis=0)
        for k in range(1, self.width):
            total += w["filters"][k].take(wide[k : k + n], axis=0)
        total[crossing] = -np.inf
        total = total.reshape(-1, self.hop, self.n_filters)
        where = total.argmax(axis=1)
        peaks = np.take_along_axis(total, where[:, None, :], axis=1)[:, 0] + w["filter_bias"]
        (left, right), starts = self.chunks(peaks, hops)
        from_right = peaks[right] > peaks[left]
        pooled = np.where(from_right, peaks[right], peaks[left])
        hidden, largest, mean, logits = self.head(pooled, starts)
        error = (1 / (1 + np.exp(-logits)) - labels) * weight
        by_feature = error[:, None] * w["out"]
        sizes = np.diff(np.append(starts, len(pooled)))
        h = self.n_hidden
        text_of = np.repeat(np.arange(len(texts)), sizes)
        at_largest = hidden == largest[text_of]
        shares = np.add.reduceat(at_largest, starts, axis=0, dtype=np.float32)[text_of]
        d_hidden = at_largest / shares * by_feature[text_of, :h] + (by_feature[:, h:] / sizes[:, None])[text_of]
        d_hidden *= hidden > 0
        d_pooled = d_hidden @ w["hidden"]
        hop_of = np.where(from_right, right[:, None], left[:, None])
        filters = np.arange(self.n_filters)[None, :]
        position = hop_of * self.hop + where[hop_of, filters]
        size = 256 * self.n_filters
        d_filters = [
            np.bincount(
                (wide[position + k] * self.n_filters + filters).ravel(), d_pooled.ravel(), size
            ).reshape(256, -1)
            for k in range(self.width)
        ]
        return {
            "filters": np.stack(d_filters),
            "filter_bias": d_pooled.sum(axis=0),
            "hidden": d_hidden.T @ pooled,
            "hidden_bias": d_hidden.sum(axis=0),
            "out": np.hstack([largest, mean]).T @ error,
            "out_bias": np.array([error.sum()]),
        }

    def fit(
        self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray,
        epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = 1,
    ) -> ByteCnn:
        """Adam over shuffled batches with a falling rate."""
        self.initial(seed)
        draw = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        steps = max(1, epochs * -(-len(texts) // batch))
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(texts))
            for a in range(0, len(order), batch):
                some = order[a : a + batch]
                found = self.gradients([texts[i] for i in some], labels[some], weight[some] / len(some))
                step += 1
                now = rate * (1 - step / (steps + 1))
                for k, g in found.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - now * move).astype(np.float32)
        return self


def training_rows(
    docs: DataFrame, labels: DataFrame, per_class: int, max_train_bytes: int, ident: str = "doc_id"
) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A bounded sample of labelled texts, chosen by the hash of the key, with labels and weights."""
    known = labels.where("quality IN (0, 1)").groupBy(ident).agg(F.min("quality").alias("label"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    texts, ys, ws = [], [], []
    for label, total in sorted(totals.items()):
        chosen = known.where(F.col("label") == label).orderBy(F.xxhash64(ident), ident).limit(per_class)
        found = (
            docs.select(ident, "text")
            .join(F.broadcast(chosen), ident)  # at most per_class rows
            .where(F.octet_length(F.coalesce("text", F.lit(""))) <= max_train_bytes)
            .dropDuplicates([ident])
            .orderBy(ident)
            .select("text")
            .limit(per_class)
            .collect()
        )
        texts += [(r["text"] or "").encode("utf-8", "replace") for r in found]
        ys += [label] * len(found)
        ws += [total / sum(totals.values()) / max(1, len(found))] * len(found)
    weight = np.array(ws) * len(ws)
    return texts, np.array(ys, np.float32), (weight / weight.mean() if len(ws) else weight).astype(np.float32)


def fit_quality(
    docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_train_bytes: int = 16384, **fit
) -> ByteCnn:
    """A network fitted on a bounded sample of the labelled rows it is given."""
    texts, ys, weight = training_rows(docs, labels, per_class, max_train_bytes)
    if len(set(ys.tolist())) < 2:
        return ByteCnn(prior=float(ys[0]) if len(ys) else 0.5)
    return ByteCnn(prior=float((ys * weight).mean())).fit(texts, ys, weight, **fit)


def add_quality(docs: DataFrame, model: ByteCnn, text: str = "text", into: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text; a column named ``into`` is replaced."""
    kept = docs.drop(into)
    schema = StructType(list(kept.schema.fields)).add(into, DoubleType())

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores: list[np.ndarray] = []
            for a in range(0, batch.num_rows, 256):
                texts = batch.column(text).slice(a, 256).to_pylist()
                scores.append(score([(x or "").encode("utf-8", "replace") for x in texts]))
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, into]
            )

    return kept.mapInArrow(mapped, schema)


def trained_on(spark: SparkSession, sf_dir: str) -> ByteCnn:
    """The model of the given tables: labels whose remainder modulo 4 is 2 are held out."""
    docs = table(spark, sf_dir, "documents").where(remainder("doc_id", 4) != 2)
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    return fit_quality(docs, labels)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = add_quality(docs, trained_on(spark, sf_dir))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"),
    )
