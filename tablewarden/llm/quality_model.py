"""Quality classifier: pooled random-indexing word vectors and a two-layer network.

The word vectors come from all documents (``word_vectors``). A document is the mean and the
spread of the vectors of its words. A network with one hidden layer learns from a bounded
sample of labelled rows on the driver; part of the sample is kept back to choose the round of
training and to fit the temperature by which scores become calibrated probabilities.
Scoring runs over all documents in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import bounded_sample, held_out, to_batch, training_rows
from tablewarden.llm.word_vectors import SIZE, split_batches, word_buckets, word_vectors

# Labelled rows that the network learns from at most.
TRAIN_ROWS = 8_000
HIDDEN = 32
ROUNDS = 60
THRESHOLD = 0.3
# Bytes of text pooled at a time.
PART_BYTES = 1 << 20


def pooled(data: np.ndarray, begins: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text; zeros for a text without words."""
    out = np.zeros((len(begins), 2 * SIZE), np.float32)
    buckets, start = word_buckets(data)
    if not len(buckets):
        return out
    vectors = np.take(table, buckets, axis=0)
    first = np.searchsorted(start, begins)
    count = np.diff(np.r_[first, len(start)])
    some = np.flatnonzero(count)
    n = count[some][:, None]
    mean = np.add.reduceat(vectors, first[some], axis=0) / n
    square = np.add.reduceat(vectors * vectors, first[some], axis=0) / n
    out[some, :SIZE] = mean
    out[some, SIZE:] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


@dataclass(frozen=True)
class Network:
    """Weights of both layers, how inputs are scaled, and the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def log_loss(y: np.ndarray, p: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _prior(y: np.ndarray, width: int) -> Network:
    """Without rows of both classes there is nothing to learn: the share of label 1, smoothed."""
    share = (y.sum() + 1) / (len(y) + 2)
    zero = np.zeros(width, np.float32)
    return Network(
        zero, zero + 1, np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0
    )


def train(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """Adam on the log loss with a little weight decay."""
    if len(y) < 10 or y.min() == y.max():
        return _prior(y, x.shape[1] if x.ndim == 2 else 2 * SIZE)
    rng = np.random.default_rng(seed)
    kept_back = np.arange(len(y)) % 5 == 0
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-4
    z = (x - centre) / scale
    zt, yt, zv, yv = z[~kept_back], y[~kept_back], z[kept_back], y[kept_back]
    weights = [
        rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    best, best_loss, step = [w.copy() for w in weights], np.inf, 0
    for _ in range(ROUNDS):
        for rows in np.array_split(rng.permutation(len(yt)), max(1, len(yt) // 128)):
            hidden = np.tanh(zt[rows] @ weights[0] + weights[1])
            error = (sigmoid(hidden @ weights[2] + weights[3]) - yt[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden * hidden)
            grads = [
                zt[rows].T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                hidden.T @ error + 1e-4 * weights[2],
                error.sum(keepdims=True),
            ]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        loss = log_loss(yv, sigmoid(np.tanh(zv @ weights[0] + weights[1]) @ weights[2] + weights[3]))
        if loss < best_loss:
            best, best_loss = [w.copy() for w in weights], loss
    logits = np.tanh(zv @ best[0] + best[1]) @ best[2] + best[3]
    choices = np.geomspace(0.25, 8, 60)
    temperature = min(choices, key=lambda t: log_loss(yv, sigmoid(logits / t)))
    return Network(centre, scale, best[0], best[1], best[2], float(best[3][0]), float(temperature))


def pool_texts(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(id, mark, label, vector) of rows (id, mark, label, text)."""
    schema = pa.schema(
        [("id", pa.int64()), ("mark", pa.int64()), ("label", pa.int32()), ("vector", pa.list_(pa.float32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, begins in split_batches(batches, PART_BYTES):
            yield to_batch(schema, [*map(list, zip(*keys)), list(pooled(data, begins, table))])

    return rows.mapInArrow(run, "id long, mark long, label int, vector array<float>")


def fit(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> tuple[np.ndarray, Network]:
    """Word vectors of all ``docs`` and the network, from at most ``train_rows`` labelled rows.

    Held-out ids are never learned from. Rows whose label is NULL or not 0 or 1 do not count.
    """
    table = word_vectors(docs.select(text_col))
    sample = F.broadcast(bounded_sample(training_rows(labels, label, id_col), train_rows, id_col))
    chosen = docs.select(id_col, text_col).join(sample, id_col).select(
        F.col(id_col).cast("long"), F.xxhash64(text_col), "__label", text_col
    )
    found = pool_texts(chosen, table).collect()
    # By row, so that the network does not depend on the order in which rows come.
    found.sort(key=lambda r: (r["id"], r["mark"]))
    order = np.random.default_rng(3).permutation(len(found))
    x = np.array([found[i]["vector"] for i in order], np.float32)
    y = np.array([found[i]["label"] for i in order], np.float64)
    return table, train(x, y)


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``.

    A NULL or empty text is scored as a text without words. Only the text is an input.
    """
    table, network = fit(docs, labels, label, id_col, text_col)
    schema = pa.schema([("id", pa.int64()), ("held", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, data, begins in split_batches(batches, PART_BYTES):
            score = network.scores(pooled(data, begins, table)).astype(np.float64)
            yield to_batch(schema, [[k[0] for k in keys], [k[1] for k in keys], score])

    rows = docs.select(F.col(id_col).cast("long"), held_out(id_col), F.col(text_col))
    scored = rows.mapInArrow(run, "id long, held boolean, score double")
    return scored.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
