"""Random-indexing word vectors over a whole corpus.

Every word has an index vector, a few random signs, that follows from the word's hash. The
vector of a word is the sum of the index vectors of the words around it in its text, wherever it occurs.
Words share ``BUCKETS`` rows by hash, so the table has a fixed size for any vocabulary.
Tasks add up their own rows and send those; the sums are whole numbers, so they do not depend
on the order of the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewarden.llm.common import PART_TYPES, sum_tables, table_parts

BUCKETS = 1 << 16
SIZE = 32
# Words on either side that count as the surroundings of a word.
REACH = 2
# Rows of the table that travel together.
CHUNK = 1 << 9
BASE = np.uint64(0x100000001B3)
POWERS = np.cumprod(np.full(256, BASE, np.uint64), dtype=np.uint64)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def word_buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word in UTF-8 bytes, and where it begins."""
    blank = np.r_[True, SPACES[data], True]
    start = np.flatnonzero(blank[:-1] & ~blank[1:])
    end = np.flatnonzero(~blank[:-1] & blank[1:])
    if not len(start):
        return np.zeros(0, np.int64), start
    # Sums of mixed bytes by their place in the word, as differences of one running sum.
    begin = np.zeros(len(data), np.int64)
    begin[start] = start
    place = np.arange(len(data)) - np.maximum.accumulate(begin)
    value = (data.astype(np.uint64) + np.uint64(1)) * POWERS[np.minimum(place, len(POWERS) - 1)]
    value ^= value >> np.uint64(23)
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)]
    hashes = total[end] - total[start]
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (hashes >> np.uint64(48)).astype(np.int64) % BUCKETS, start


def index_vectors(seed: int = 7) -> np.ndarray:
    """Four random signs per bucket."""
    rng = np.random.default_rng(seed)
    table = np.zeros((BUCKETS, SIZE), np.int8)
    rows = np.arange(BUCKETS)
    for _ in range(4):
        table[rows, rng.integers(0, SIZE, BUCKETS)] = rng.choice(np.array([-1, 1], np.int8), BUCKETS)
    return table


def _add(table: np.ndarray, buckets: np.ndarray, signs: np.ndarray, text: np.ndarray) -> None:
    """Add the surroundings of each word to the word's row; ``text`` numbers the words' texts.

    Between two texts lie as many empty places as a word's surroundings reach, so that no
    word has neighbours in another text.
    """
    place = np.arange(len(buckets)) + REACH * (1 + text)
    padded = np.zeros((place[-1] + REACH + 1, SIZE), np.int8)
    padded[place] = np.take(signs, buckets, axis=0)
    around = np.zeros((len(buckets), SIZE), np.int8)
    for shift in range(-REACH, REACH + 1):
        if shift:
            around += padded[place + shift]
    order = np.argsort(buckets)
    ordered = buckets[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    table[ordered[first]] += np.add.reduceat(np.take(around, order, axis=0), first, axis=0, dtype=np.int32)


def split_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows, bytes of their texts with a blank behind each, where each text begins).

    Each part has about ``size`` bytes, so that memory does not grow with the batch.
    """
    for batch in batches:
        rows: list = []
        parts: list[bytes] = []
        held = 0
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            data = (row[-1] or "").encode() + b" "
            rows.append(row[:-1])
            parts.append(data)
            held += len(data)
            if held >= size:
                yield _joined(rows, parts)
                rows, parts, held = [], [], 0
        if rows:
            yield _joined(rows, parts)


def _joined(rows: list, parts: list[bytes]) -> tuple[list, np.ndarray, np.ndarray]:
    begins = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    return rows, np.frombuffer(b"".join(parts), np.uint8), begins


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The table of vectors, from all texts in the one column of ``texts``.

    The table has a fixed size, so it may reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = index_vectors()
        table = np.zeros((BUCKETS, SIZE), np.int64)
        for _, data, begins in split_batches(batches, 1 << 20):
            buckets, start = word_buckets(data)
            if len(buckets):
                _add(table, buckets, signs, np.searchsorted(begins, start, side="right") - 1)
        yield from table_parts(table.reshape(BUCKETS // CHUNK, -1))

    parts = texts.mapInArrow(run, PART_TYPES)
    return unit(sum_tables(parts, (BUCKETS // CHUNK, CHUNK * SIZE)).reshape(BUCKETS, SIZE))


def unit(table: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(length, 1e-6)).astype(np.float32)
