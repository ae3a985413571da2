"""SimHash near-duplicates by meeting in the middle.

Two fingerprints that differ in at most ``max_bits`` bits have a value between them that is
at most half as far from either. Every distinct fingerprint therefore emits all values within
half the radius; fingerprints that emit the same value collide, and colliding pairs are
verified by counting the bits they differ in.

The values are shuffled by their leading bits. A fingerprint is sent once to each group of
leading bits that some of its values have, and the values of that group are made where it
arrives: the same values meet as if each were sent alone, for a fiftieth of the bytes.
All members that share a value are linked to one centre, so a group of copies gives as many
links as members and never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, components, keyed, texts, to_batch, true_id, unkeyed
from tablewarden.materialize import materialize

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Shingles hashed at a time, for very long texts.
CHUNK = 1 << 16
# Values that one task sorts at a time.
BLOCK = 1 << 22


def simhash(text: str | None, shingle: int = 4) -> int:
    """64-bit fingerprint of a text; 0 for one without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    starts = ends[: max(1, len(words) - shingle + 1)]
    stops = ends[min(shingle, len(words)) :]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], stops[at : at + CHUNK])
        packed = b"".join([digest(joined[s : e - 1], 42) for s, e in spans])
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (__id, __hash, __fp) per row of ``docs``."""
    schema = pa.schema([("__id", pa.int64()), ("__hash", pa.int64()), ("__fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, values = column_lists(batch)
            yield to_batch(schema, [ids, hashes, [_signed(simhash(t, shingle)) for t in values]])

    return texts(docs, id_col, text_col).mapInArrow(run, "__id long, __hash long, __fp long")


def _flips(bits: int, radius: int) -> list[np.ndarray]:
    """Masks over ``bits`` bits, by the number of bits they flip."""
    return [
        np.array([sum(1 << b for b in c) for c in combinations(range(bits), n)], np.uint64)
        for n in range(radius + 1)
    ]


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member that each of ``size`` members is linked to."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(root, up := root[root]):
            root = up
        if np.array_equal(root, before):
            break
    return root


def collide(prefix: int, prefix_bits: int, prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Smallest fingerprint that each of ``prints`` is linked to by values with this prefix.

    For an odd radius one side may be a bit further away than the other; then only members
    on the near side can be a centre.
    """
    far, near = (max_bits + 1) // 2, max_bits // 2
    prints = np.sort(prints)
    rest = 64 - prefix_bits
    away = np.bitwise_count((prints >> np.uint64(rest)) ^ np.uint64(prefix)).astype(int)
    low = prints & np.uint64((1 << rest) - 1)
    masks = _flips(rest, far)
    total = sum(int((away + n <= far).sum()) * len(masks[n]) for n in range(far + 1))
    blocks = max(1, -(-total // BLOCK))
    root = np.arange(len(prints))
    for block in range(blocks):
        values, owners, centres = [], [], []
        for n, mask in enumerate(masks):
            members = np.flatnonzero(away + n <= far)
            step = max(1, BLOCK // len(mask))
            for at in range(0, len(members), step):
                some = members[at : at + step]
                made = (low[some][:, None] ^ mask).ravel()
                own = np.repeat(some, len(mask))
                if blocks > 1:
                    mixed = (made * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                    here = mixed % np.uint64(blocks) == block
                    made, own = made[here], own[here]
                values.append(made)
                owners.append(own)
                centres.append(away[own] + n <= near)
        value, owner, centre = (np.concatenate(x) for x in (values, owners, centres))
        order = np.argsort(value)
        value, owner, centre = value[order], owner[order], centre[order]
        first = np.r_[True, value[1:] != value[:-1]] if len(value) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(value)])
        shared = np.repeat(sizes > 1, sizes)
        none = len(prints)
        best = np.minimum.reduceat(np.where(centre, owner, none), starts) if len(starts) else starts
        to = np.repeat(best, sizes)[shared]
        of = owner[shared]
        linked = (to < none) & (to != of)
        pairs = np.unique(np.stack([to[linked], of[linked]], axis=1), axis=0)
        a, b = pairs[:, 0], pairs[:, 1]
        close = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
        member = np.arange(len(prints))
        root = _forest(len(prints), np.r_[a[close], member], np.r_[b[close], root])
    return np.stack([prints[root], prints], axis=1)


def links(prints: DataFrame, count: int, max_bits: int = 4) -> DataFrame:
    """Links (a, b) that join the fingerprints in ``prints`` (__fp) as all close pairs would."""
    radius = (max_bits + 1) // 2
    ball = sum(math.comb(64, n) for n in range(radius + 1))
    # Enough groups for each to have about a million values, at any number of fingerprints.
    bits = min(24, max(4, math.ceil(math.log2(max(1, count * ball / (1 << 20))))))
    flips = [_signed(int(m)) for group in _flips(bits, radius) for m in group]
    own = F.shiftrightunsigned("__fp", 64 - bits)
    dealt = prints.select(
        "__fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("__flip")
    ).select("__fp", own.bitwiseXOR(F.col("__flip")).alias("__prefix"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = table.column("__fp").to_numpy().astype(np.int64).view(np.uint64)
        pairs = collide(key[0].as_py(), bits, found, max_bits)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pa.table({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})

    return dealt.groupBy("__prefix").applyInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row (__id, __hash, __fp, __first_id, __first_hash) per row of ``docs``.

    ``__first_id`` and ``__first_hash`` are the first document that can be reached over
    links of at most ``max_bits`` differing bits. Texts without words have the fingerprint
    0 and are linked like others; NULL texts count as empty. A NULL id ranks last.
    """
    marked = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints").frame
    classes = materialize(
        marked.groupBy("__fp").agg(F.min(F.struct("__id", "__hash")).alias("__first")), "classes"
    )
    close = links(classes.frame.select("__fp"), classes.rows, max_bits)
    roots = components(close)
    found = materialize(
        classes.frame.join(roots, F.col("__fp") == F.col("node"), "left").select(
            "__fp", "__first", F.coalesce("root", "__fp").alias("__root")
        ),
        "roots",
    ).frame
    firsts = found.groupBy("__root").agg(F.min("__first").alias("__min"))
    of_class = materialize(
        found.join(firsts, "__root").select(
            F.col("__fp").alias("__class"),
            F.col("__min.__id").alias("__first_id"),
            F.col("__min.__hash").alias("__first_hash"),
        ),
        "firsts",
    ).frame
    return marked.join(of_class, F.col("__fp") == F.col("__class")).drop("__class")


def component_report(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    return near_duplicates(docs, shingle, max_bits).select(
        true_id().alias("doc_id"),
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        true_id("__first_id").alias("component_id"),
    )


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each group; of rows that repeat it one stays."""
    groups = near_duplicates(docs, shingle, max_bits)
    first = groups.where("__id = __first_id and __hash = __first_hash")
    chosen = first.select("__id", "__hash").distinct()
    kept = keyed(docs).join(chosen.hint("merge"), ["__id", "__hash"], "left_semi")
    return unkeyed(kept.dropDuplicates(["__id", "__hash"]), docs)
