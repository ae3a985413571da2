"""Minimal perfect hashing of 64-bit keys, built in buckets by Spark tasks.

Each bucket has levels of bits. A key sets the bit of its hash in a level if no other key of
the level shares it; the others go on to the next level. The number of set bits before a
key's bit is its index, so n keys take the numbers from 0 to n - 1. The bits of all buckets
lie one behind the other, so that one rank over all of them numbers all keys. The key of each
index is kept beside it: looking up a key that was not hashed gives -1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import to_batch
from tablewarden.materialize import materialize

# Keys of a bucket, about, and of a block of buckets that a task holds at a time.
BUCKET_KEYS = 1 << 16
BLOCK_KEYS = 1 << 22
# Bits of a level per key that is left.
ROOM = 1.5
WORD = 64


def mix(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of 64-bit keys."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _level(keys: np.ndarray, level: int, words: np.ndarray | int) -> np.ndarray:
    """Bit of each key in a level of so many words."""
    return (mix(keys, level + 1) % (np.uint64(WORD) * np.asarray(words, np.uint64))).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(words of each level, bits, keys in the order of their index) of distinct keys."""
    sizes, bits, placed = [], [], []
    left = keys
    while len(left):
        words = max(1, int(len(left) * ROOM) // WORD)
        bit = _level(left, len(sizes), words)
        alone = np.bincount(bit, minlength=words * WORD) == 1
        fits = alone[bit]
        bits.append(np.packbits(alone, bitorder="little"))
        placed.append(left[fits][np.argsort(bit[fits])])
        left = left[~fits]
        sizes.append(words)
    return sizes, np.concatenate(bits), np.concatenate(placed)


@dataclass
class Table:
    """The buckets from ``first`` on; all keys have 2 ** ``power`` buckets."""

    power: int
    first: int
    words: np.ndarray  # of each level, by bucket and level; 0 where a bucket has no such level
    begin: np.ndarray  # first word of each level
    bits: np.ndarray
    before: np.ndarray  # set bits before each word
    keys: np.ndarray

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index within the block of each key, -1 for keys that are not in it."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.power) - self.first
        row = np.flatnonzero((bucket >= 0) & (bucket < len(self.words)))
        for level in range(self.words.shape[1]):
            row = row[self.words[bucket[row], level] > 0]
            if not len(row):
                break
            bit = _level(keys[row], level, self.words[bucket[row], level])
            word = self.begin[bucket[row], level] + (bit >> 6)
            held, low = self.bits[word], (bit & 63).astype(np.uint64)
            found = (held >> low) & np.uint64(1) == 1
            below = np.bitwise_count(held & ((np.uint64(1) << low) - np.uint64(1)))
            out[row[found]] = (self.before[word] + below)[found]
            row = row[~found]
        known = np.flatnonzero(out >= 0)
        out[known[self.keys[out[known]] != keys[known]]] = -1
        return out


def bucket_of(keys: np.ndarray, power: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(WORD - power)).astype(np.int64) if power else np.zeros(len(keys), np.int64)


BUCKETS = pa.schema(
    [("bucket", pa.int64()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("keys", pa.binary())]
)
BUCKET_TYPES = "bucket long, n long, sizes array<bigint>, bits binary, keys binary"


@dataclass
class Buckets:
    """Written buckets, and which of them make up each block: (first, end)."""

    power: int
    frame: DataFrame
    blocks: list[tuple[int, int]]
    keys: int

    def block(self, n: int) -> Table:
        """The table of one block."""
        first, end = self.blocks[n]
        rows = self.frame.where(F.col("bucket").between(first, end - 1)).toLocalIterator()
        held = {r["bucket"]: r for r in rows}
        depth = max((len(r["sizes"]) for r in held.values()), default=0)
        words = np.zeros((end - first, depth), np.int64)
        for bucket, r in held.items():
            words[bucket - first, : len(r["sizes"])] = r["sizes"]
        ordered = [held[b] for b in sorted(held)]
        bits = np.frombuffer(b"".join(r["bits"] for r in ordered), "<u8")
        keys = np.frombuffer(b"".join(r["keys"] for r in ordered), "<i8")
        ones = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
        before = np.concatenate([[0], ones])[:-1]
        begin = (np.cumsum(words.ravel()) - words.ravel()).reshape(words.shape)
        return Table(self.power, first, words, begin, bits, before, keys)


def build(keys: DataFrame, count: int) -> Buckets:
    """Perfect hash of the distinct longs in the column ``key`` of ``keys``, ``count`` of them."""
    power = max(0, (count // BUCKET_KEYS).bit_length())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bucket_of(key, power))], ["key", "bucket"])

    def one(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The order in which keys arrive must not matter.
        own = np.sort(np.concatenate([b.column("key").to_numpy() for b in batches]))
        sizes, bits, placed = build_bucket(own)
        yield to_batch(
            BUCKETS, [[group[0].as_py()], [len(own)], [sizes], [bits.tobytes()], [placed.astype("<i8").tobytes()]]
        )

    dealt = keys.select("key").mapInArrow(deal, "key long, bucket long")
    frame = materialize(dealt.groupBy("bucket").applyInArrow(one, BUCKET_TYPES), "buckets").frame
    # One short row per bucket.
    sizes = np.zeros(1 << power, np.int64)
    for r in frame.select("bucket", "n").toLocalIterator():
        sizes[r["bucket"]] = r["n"]
    blocks, first, held = [], 0, 0
    for bucket, n in enumerate(sizes.tolist()):
        if held and held + n > BLOCK_KEYS:
            blocks.append((first, bucket))
            first, held = bucket, 0
        held += n
    return Buckets(power, frame, [*blocks, (first, 1 << power)], int(sizes.sum()))
