"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, and a linear model.

A document is the set of its hashed character n-grams. For each n-gram, the share of toxic
and of other training documents that have it gives a log ratio, counted over all labelled
training rows in one pass. A logistic regression on the scaled features learns from a bounded
sample; the last part of the sample calibrates its scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import (
    PART_TYPES,
    bounded_sample,
    column_lists,
    held_out,
    sum_tables,
    table_parts,
    to_batch,
    training_rows,
)
from tablewarden.llm.quality_model import sigmoid

# Bytes of an n-gram: short ones for stems, longer ones for words built from common syllables.
SIZES = (5, 7)
BITS = 18
FEATURES = 1 << BITS
CHUNK = 1 << 12
# Labelled rows that the linear model learns from at most.
TRAIN_ROWS = 4_000
ROUNDS = 4
THRESHOLD = 0.5
# Lower case, and every blank a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32


def features(text: str | None) -> np.ndarray:
    """Sorted numbers of the n-grams in a text, each once."""
    if not text:
        return np.zeros(0, np.int64)
    data = FOLD[np.frombuffer(f" {text}{' ' * 7}".encode(), np.uint8)].astype(np.uint64)
    two = data[:-1] | (data[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    eight = four[:-4] | (four[4:] << np.uint64(32))
    found = []
    for n in SIZES:
        grams = eight & np.uint64((1 << 8 * n) - 1)
        hashed = (grams * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - BITS)
        found.append(hashed.astype(np.int64))
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Linear:
    """Weight of each feature, its ratio included, and the calibrated offset and slope."""

    weights: np.ndarray
    offset: float
    slope: float

    def score(self, found: np.ndarray) -> float:
        raw = float(self.weights[found].sum()) / np.sqrt(max(1, len(found)))
        return float(sigmoid(np.float64(self.slope * raw + self.offset)))


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of both classes; row 2 holds the numbers of documents."""
    other, toxic, documents = counts[0] + 1.0, counts[1] + 1.0, counts[2]
    return np.log(toxic / (documents[1] + 2)) - np.log(other / (documents[0] + 2))


def count_features(rows: DataFrame) -> np.ndarray:
    """Documents of each class that have a feature, from rows (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((3, FEATURES), np.int64)
        for batch in batches:
            for label, text in zip(*column_lists(batch)):
                table[label, features(text)] += 1
                table[2, label] += 1
        yield from table_parts(table.reshape(-1, CHUNK))

    shape = (3 * FEATURES // CHUNK, CHUNK)
    return sum_tables(rows.mapInArrow(run, PART_TYPES), shape).reshape(3, FEATURES)


def train(found: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, seed: int = 5) -> Linear:
    """Adaptive gradient steps on the log loss, then slope and offset on the last fifth."""
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Linear(np.zeros(FEATURES, np.float32), float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(FEATURES), 0.0
    steps, bias_steps = np.full(FEATURES, 1e-2), 1e-2
    cut = len(y) * 4 // 5
    for _ in range(ROUNDS):
        for i in rng.permutation(cut):
            at = found[i]
            x = ratio[at] / np.sqrt(max(1, len(at)))
            error = float(sigmoid(np.float64(weights[at] @ x + bias))) - y[i]
            steps[at] += (error * x) ** 2
            weights[at] -= 0.5 * error * x / np.sqrt(steps[at])
            bias_steps += error * error
            bias -= 0.5 * error / np.sqrt(bias_steps)
    whole = weights * ratio
    raw = np.array([whole[at].sum() / np.sqrt(max(1, len(at))) for at in found[cut:]])
    slope, offset = _calibrate(raw, y[cut:], bias)
    return Linear(whole.astype(np.float32), offset, slope)


def _calibrate(raw: np.ndarray, y: np.ndarray, bias: float) -> tuple[float, float]:
    """Slope and offset by Newton steps on smoothed targets, from the trained ones on."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y == 1, high, low)
    a = np.array([1.0, bias])
    design = np.stack([raw, np.ones_like(raw)], axis=1)
    for _ in range(50):
        p = sigmoid(design @ a)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        a = a - np.clip(np.linalg.solve(hessian, design.T @ (p - target)), -1, 1)
    return float(a[0]), float(a[1])


def fit(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> Linear:
    """Ratios from all labelled training rows, weights from at most ``train_rows`` of them."""
    known = training_rows(labels, label, id_col)
    # One plan at every size, although few labels could be sent to all tasks.
    rows = docs.select(id_col, text_col).join(known.hint("merge"), id_col).select("__label", text_col)
    ratio = ratios(count_features(rows))
    sample = F.broadcast(bounded_sample(known, train_rows, id_col))
    chosen = docs.select(id_col, text_col).join(sample, id_col).select(id_col, "__label", text_col)
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("found", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, texts = column_lists(batch)
            yield to_batch(schema, [ids, marks, [features(t).astype("<u4").tobytes() for t in texts]])

    got = chosen.mapInArrow(run, "id long, label int, found binary").collect()
    got.sort(key=lambda r: (r["id"], bytes(r["found"])))
    order = np.random.default_rng(3).permutation(len(got))
    found = [np.frombuffer(got[i]["found"], "<u4") for i in order]
    return train(found, np.array([got[i]["label"] for i in order], np.float64), ratio)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``.

    A NULL or empty text has no n-grams and gets the score of the offset. Only the text is an
    input.
    """
    model = fit(docs, labels, label, id_col, text_col)
    schema = pa.schema([("id", pa.int64()), ("held", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, texts = column_lists(batch)
            yield to_batch(schema, [ids, held, [model.score(features(t)) for t in texts]])

    rows = docs.select(F.col(id_col).cast("long"), held_out(id_col), F.col(text_col))
    return rows.mapInArrow(run, "id long, held boolean, score double").select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
