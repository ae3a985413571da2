"""Removal of long byte strings that also start in an earlier document.

Every window of ``WINDOW`` bytes belongs to the least of the hashes of its ``ANCHOR``-byte
strings. Neighbouring windows of the same anchor form one segment, and equal windows have
equal anchors wherever they occur, so segments can be dealt into buckets by anchor and each
bucket sees all copies of its windows.

1. Documents are packed into blocks, which are written once.
2. Each block sends its distinct segments to the buckets, with the least id that has them: a
   passage that very many documents share leaves a block once.
3. A bucket drops segments whose surroundings of the anchor occur in one document only, and
   builds a run-length index (``run_index``) of the others. Streaming them through it gives
   for each place how early the next ``WINDOW`` bytes occur elsewhere.
4. The answers go back to the blocks, where the covered bytes are cut out.

Tasks hold one block or one bucket at a time, and an index is built for a bounded number of
bytes, whole anchors at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, id_rank, shuffles_removed, true_id
from tablewarden.llm.run_index import build, stream
from tablewarden.materialize import materialize

WINDOW = 50
ANCHOR = 16
# Bytes on one side of the anchor that every window around it has on at least one side.
SIDE = -(-(WINDOW - ANCHOR) // 2)
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
INDEX_BYTES = 1 << 18
# Compression of texts and segments: they are written once and read once, so bytes weigh more than time.
LEVEL = 5
# Windows whose anchors are found at a time; the arrays fit the cache of a core.
PART = 1 << 15
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pack(values: np.ndarray) -> bytes:
    """Compressed numbers, byte planes apart."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def _lanes(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as one number, without a copy."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,))


def _mix(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    mixed = (low * ONE) ^ ((high * TWO) >> np.uint64(17)) ^ (high * ONE)
    mixed ^= mixed >> np.uint64(29)
    return mixed * TWO


@dataclass(frozen=True)
class Segments:
    """Segments of a block: where each begins and ends, its anchor within it, its bucket."""

    start: np.ndarray
    end: np.ndarray
    anchor: np.ndarray
    bucket: np.ndarray


def _anchors(lanes: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of the anchor of the windows that start from ``begin`` to ``end``."""
    wide = WINDOW - ANCHOR + 1
    eight = np.array(lanes[begin : end + wide - 1 + 8])
    hashes = _mix(eight[:-8], eight[8:])
    bits = np.uint64(int(len(hashes)).bit_length())
    least, have = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64), 1
    while have < wide:
        step = min(have, wide - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return place + begin, np.take(hashes, place)


def segments(data: np.ndarray, begins: np.ndarray, buckets: int) -> Segments:
    """Segments of the documents that lie one behind the other in ``data``."""
    none = np.zeros(0, np.int64)
    windows = len(data) - WINDOW + 1
    if windows < 1:
        return Segments(none, none, none, none)
    lanes = _lanes(data)
    # Windows that reach into the next document do not count.
    edge = np.zeros(windows + 1, np.int32)
    stops = begins[1:]
    np.add.at(edge, np.clip(stops - WINDOW + 1, 0, windows), 1)
    np.add.at(edge, np.clip(stops, 0, windows), -1)
    inside = np.cumsum(edge[:-1]) == 0
    firsts, places, hashed = [], [], []
    last = (-1, False)
    for begin in range(0, windows, PART):
        end = min(windows, begin + PART)
        place, value = _anchors(lanes, begin, end)
        here = inside[begin:end]
        new = np.empty(end - begin, bool)
        new[0] = last != (place[0], here[0])
        np.not_equal(place[1:], place[:-1], out=new[1:])
        new[1:] |= here[1:] != here[:-1]
        at = np.flatnonzero(new)
        firsts.append(at + begin)
        places.append(np.take(place, at))
        hashed.append(np.take(value, at))
        last = (place[-1], here[-1])
    first, place, value = (np.concatenate(x) for x in (firsts, places, hashed))
    after = np.r_[first[1:], windows]
    use = inside[first]
    first, after, place, value = first[use], after[use], place[use], value[use]
    bucket = ((value * ONE) >> np.uint64(33)) % np.uint64(buckets)
    return Segments(first, after + WINDOW - 1, place - first, bucket.astype(np.int64))


def _numbered(data: np.ndarray, found: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments in the order of their buckets, the number of each one's text within its
    bucket, and which of them are the first of their text.

    Equal texts are told by 128 bits of hash and by bucket.
    """
    lanes = _lanes(data)
    low, high = np.zeros((2, len(found.start)), np.uint64)
    last = found.end - 8
    for step in range(0, 2 * WINDOW - ANCHOR, 8):
        lane = lanes[np.minimum(found.start + step, last)]
        low = (low ^ lane) * ONE
        low ^= low >> np.uint64(29)
        high = (high + lane) * TWO
        high ^= high >> np.uint64(31)
    low ^= (found.end - found.start).astype(np.uint64)
    key = (found.bucket.astype(np.uint64) << np.uint64(44)) | (low >> np.uint64(20))
    order = np.argsort(key, kind="stable")
    key, low, high, bucket = key[order], low[order], high[order], found.bucket[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    number = np.cumsum(new)
    begins = np.searchsorted(bucket, bucket, side="left")
    return order, number - number[begins], new


BLOCK_FIELDS = [("__block", pa.int64()), ("__ids", pa.binary()), ("__sizes", pa.binary()), ("__data", pa.binary())]
BLOCK_TYPES = "__block long, __ids binary, __sizes binary, __data binary"


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents packed into rows of about ``BLOCK_BYTES``, without a shuffle."""
    schema = pa.schema(BLOCK_FIELDS)

    def row(number: int, ids: list[int], texts: list[bytes]) -> pa.RecordBatch:
        block = (TaskContext.get().partitionId() << 32) + number
        sizes = np.array([len(t) for t in texts], np.int64)
        packed = [pack(np.array(ids, np.int64)), pack(sizes), zstandard.compress(b"".join(texts), LEVEL)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip([block, *packed], schema)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        number = held = 0
        for batch in batches:
            for doc, text in zip(*column_lists(batch)):
                data = (text or "").encode()
                if ids and held + len(data) > BLOCK_BYTES:
                    yield row(number, ids, texts)
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc)
                texts.append(data)
                held += len(data)
        if ids:
            yield row(number, ids, texts)

    return docs.select(id_rank(id_col), F.col(text_col)).mapInArrow(run, BLOCK_TYPES)


@dataclass(frozen=True)
class Block:
    ids: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def open_block(ids: bytes, sizes: bytes, data: bytes) -> Block:
    return Block(unpack(ids, "i8"), unpack(sizes, "i8"), np.frombuffer(zstandard.decompress(data), np.uint8))


def _sent(packed: DataFrame, buckets: int) -> DataFrame:
    """Distinct segments of each block by bucket, with the least id and whether others have them."""
    fields = [("__bucket", pa.int32()), ("__block", pa.int64())]
    fields += [(n, pa.binary()) for n in ("__first", "__more", "__length", "__anchor", "__body")]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *parts in zip(*column_lists(batch)):
                block = open_block(*parts)
                found = segments(block.data, block.begins, buckets)
                if not len(found.start):
                    continue
                order, text_of, first = _numbered(block.data, found)
                starts, ends, anchors, bucket = (
                    x[order] for x in (found.start, found.end, found.anchor, found.bucket)
                )
                doc = np.searchsorted(block.begins, starts, side="right") - 1
                ids = block.ids[doc]
                raw = block.data.tobytes()
                cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                for start, stop in zip(cut, np.r_[cut[1:], len(bucket)]):
                    own = start + np.flatnonzero(first[start:stop])
                    least = np.minimum.reduceat(ids[start:stop], own - start)
                    most = np.maximum.reduceat(ids[start:stop], own - start)
                    spans = zip(starts[own].tolist(), ends[own].tolist())
                    row = [
                        int(bucket[start]), number, pack(least), pack((most > least).astype(np.uint8)),
                        pack((ends - starts)[own].astype(np.uint8)), pack(anchors[own].astype(np.uint8)),
                        zstandard.compress(b"".join([raw[a:b] for a, b in spans]), LEVEL),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema
                    )

    names = "__bucket int, __block long, __first binary, __more binary, __length binary, __anchor binary, __body binary"
    return packed.mapInArrow(run, names)


def _shared(key: np.ndarray, ids: np.ndarray, more: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Which entries have a key that documents of different ids have."""
    at = np.flatnonzero(able)
    order = at[np.argsort(key[at])]
    if not len(order):
        return able
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    group = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    low = np.minimum.reduceat(ids[order], begins)
    high = np.maximum.reduceat(ids[order], begins)
    several = np.maximum.reduceat(more[order], begins)
    shared = np.zeros(len(key), bool)
    shared[order] = ((low < high) | (several > 0))[group]
    return shared


def _fold(lanes: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` bytes, eight or more, from each start on."""
    value = np.zeros(len(start), np.uint64)
    for n in sorted({*range(0, size - 7, 8), size - 8}):
        value = (value ^ lanes[np.clip(start + n, 0, len(lanes) - 1)]) * ONE
        value ^= value >> np.uint64(31)
    return value


ANSWER = [("__block", pa.int64()), ("__bucket", pa.int32())]
ANSWER += [(n, pa.binary()) for n in ("__text", "__from", "__to", "__least")]
ANSWER_TYPES = "__block long, __bucket int, __text binary, __from binary, __to binary, __least binary"


def _answers(bucket: int, rows: list[dict]) -> Iterator[tuple]:
    """For each block that sent segments, the stretches of them that occur elsewhere as well,
    and the least id that has their windows."""
    length = np.concatenate([unpack(r["__length"], "u1") for r in rows]).astype(np.int64)
    sizes = [len(unpack(r["__length"], "u1")) for r in rows]
    sender = np.repeat(np.arange(len(rows)), sizes)
    number = np.concatenate([np.arange(n) for n in sizes])
    ids = np.concatenate([unpack(r["__first"], "i8") for r in rows])
    more = np.concatenate([unpack(r["__more"], "u1") for r in rows])
    anchor = np.concatenate([unpack(r["__anchor"], "u1") for r in rows]).astype(np.int64)
    raw = b"".join(zstandard.decompress(r["__body"]) for r in rows)
    lanes = _lanes(np.frombuffer(raw, np.uint8))
    start = np.cumsum(length) - length
    core = _fold(lanes, start + anchor, ANCHOR)
    left = core ^ _fold(lanes, np.maximum(start + anchor - SIDE, 0), SIDE)
    right = core + _fold(lanes, start + anchor + ANCHOR, SIDE) * TWO
    use = _shared(left, ids, more, anchor >= SIDE) | _shared(
        right, ids, more, length - anchor - ANCHOR >= SIDE
    )
    used = np.flatnonzero(use)
    used = used[np.argsort(core[used], kind="stable")]
    # Whole anchors at a time, so that all copies of a window meet in one index.
    total = np.cumsum(length[used])
    found: list[tuple[np.ndarray, ...]] = []
    begin = 0
    while begin < len(used):
        goal = (total[begin - 1] if begin else 0) + INDEX_BYTES
        end = max(begin + 1, int(np.searchsorted(total, goal)))
        while end < len(used) and core[used[end]] == core[used[end - 1]]:
            end += 1
        found.append(_indexed(used[begin:end], raw, start, length, ids, more))
        begin = end
    if not found:
        return
    entry, low, high, least = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(sender[entry], kind="stable")
    entry, low, high, least = entry[order], low[order], high[order], least[order]
    cut = np.flatnonzero(np.r_[True, sender[entry][1:] != sender[entry][:-1]]) if len(entry) else []
    for a, b in zip(cut, [*cut[1:], len(entry)]):
        at = entry[a:b]
        yield (
            rows[int(sender[at[0]])]["__block"], bucket, pack(number[at].astype(np.uint32)),
            pack(low[a:b].astype(np.uint8)), pack(high[a:b].astype(np.uint8)), pack(least[a:b]),
        )


def _indexed(
    used: np.ndarray, raw: bytes, start: np.ndarray, length: np.ndarray, ids: np.ndarray, more: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(entry, from, to, least id) of stretches whose windows occur in an earlier document
    than some that has the entry."""
    known: dict[bytes, int] = {}
    which = np.empty(len(used), np.int64)
    for n, (a, size) in enumerate(zip(start[used].tolist(), length[used].tolist())):
        which[n] = known.setdefault(raw[a : a + size], len(known))
    strings = list(known)
    sizes = np.array([len(s) for s in strings], np.int64)
    weights = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(weights, which, ids[used])
    body = np.frombuffer(b"".join(strings), np.uint8)
    best, _ = stream(build(body, sizes, weights, WINDOW), sizes)
    begin = np.cumsum(sizes) - sizes
    windows = length[used] - WINDOW + 1
    owner = np.repeat(np.arange(len(used)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    least = best[begin[which[owner]] + place]
    entry = used[owner]
    hit = (least < ids[entry]) | (more[entry] > 0)
    entry, place, least = entry[hit], place[hit], least[hit]
    if not len(entry):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    new = np.r_[True, (entry[1:] != entry[:-1]) | (place[1:] != place[:-1] + 1) | (least[1:] != least[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(entry)] - 1
    return entry[first], place[first], place[last] + WINDOW, least[first]


def _covered(block: Block, buckets: int, answers: pa.Table) -> np.ndarray:
    """Which bytes of a block go."""
    edge = np.zeros(len(block.data) + 1, np.int32)
    rows = answers.to_pylist()
    if rows:
        found = segments(block.data, block.begins, buckets)
        order, text_of, _ = _numbered(block.data, found)
        doc = np.searchsorted(block.begins, found.start[order], side="right") - 1
        ids, bucket, start = block.ids[doc], found.bucket[order], found.start[order]
        for row in rows:
            a, b = np.searchsorted(bucket, [row["__bucket"], row["__bucket"] + 1])
            text, low, high, least = (
                unpack(row[n], k)
                for n, k in (("__text", "u4"), ("__from", "u1"), ("__to", "u1"), ("__least", "i8"))
            )
            by_text = np.argsort(text, kind="stable")
            text, low, high, least = text[by_text], low[by_text], high[by_text], least[by_text]
            at = text_of[a:b]
            first = np.searchsorted(text, at, side="left")
            many = np.searchsorted(text, at, side="right") - first
            pick = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            own = np.repeat(np.arange(a, b), many)
            earlier = least[pick] < ids[own]
            pick, own = pick[earlier], own[earlier]
            np.add.at(edge, start[own] + low[pick].astype(np.int64), 1)
            np.add.at(edge, start[own] + high[pick].astype(np.int64), -1)
    return np.cumsum(edge[:-1]) > 0


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, removed) per row of ``docs``: the bytes left and the (start, end) cut out.

    A byte goes if it lies in ``WINDOW`` bytes that also start in a document with a smaller
    id. NULL texts count as empty. A NULL id counts as larger than all others, and rows of
    equal ids as one document: they do not shorten each other.
    """
    packed = materialize(blocks(docs, id_col, text_col), "blocks").frame
    # Each byte is sent about four times.
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET_BYTES))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        made = list(zip(*_answers(key[0].as_py(), table.to_pylist()))) or [[] for _ in ANSWER]
        return pa.table([pa.array(v, f[1]) for v, f in zip(made, ANSWER)], schema=pa.schema(ANSWER))

    answers = _sent(packed, buckets).groupBy("__bucket").applyInArrow(ask, ANSWER_TYPES)
    # The segments that were sent are done with when the answers are written.
    with shuffles_removed(docs.sparkSession):
        answers = materialize(answers, "answers").frame
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("__id", pa.int64()), ("__n", pa.int64()), ("__left", pa.binary()), ("removed", span)])

    def cut(_: tuple, block_rows: pa.Table, answer_rows: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in schema]
        for _number, *parts in zip(*(c.to_pylist() for c in block_rows.columns)):
            block = open_block(*parts)
            gone = _covered(block, buckets, answer_rows)
            for doc, begin, size in zip(block.ids.tolist(), block.begins.tolist(), block.sizes.tolist()):
                mine = gone[begin : begin + size]
                edges = np.flatnonzero(np.diff(np.r_[False, mine, False]))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                left = block.data[begin : begin + size][~mine].tobytes()
                for column, value in zip(out, (doc, size, left, spans)):
                    column.append(value)
        return pa.table([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    types = "__id long, __n long, __left binary, removed array<struct<start:long,end:long>>"
    done = packed.groupBy("__block").cogroup(answers.groupBy("__block")).applyInArrow(cut, types)
    return done.select(true_id().alias(id_col), F.col("__n").alias("n_bytes"), F.col("__left").alias("left"), "removed")


def substring_report(docs: DataFrame) -> DataFrame:
    """Per document its bytes, those removed, the runs they form, and a digest of the rest."""
    left = dedup_substrings(docs.select("doc_id", "text"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("left")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("left", 256).alias("kept_sha256"),
    )
