"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens in one pass. Only the number of pieces
of each length reaches the driver, at most ``capacity`` numbers. The plan is made over these
counts: the longest lengths first, as many pieces of a length at once as there are sequences
of the tightest room for it. A plan row says that the pieces of a length with ranks from
``rank`` on take the same offset in as many consecutive sequences. Pieces are ranked within
their length and take the slot of their rank.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewarden.llm.common import column_lists, texts, to_batch, true_id
from tablewarden.materialize import materialize

CAPACITY = 1024
# Id put behind every document.
END_ID = 2
# How byte-level vocabularies split text before merging: a fixed value of their format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_letter() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others follow from code point 256 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def vocabulary(path: str) -> dict:
    """Byte strings and ids of a byte-level vocabulary file, and its special tokens.

    The ids must follow the merges in order, which makes an id the rank of its merge.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_of_letter()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ids = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in word): n for word, n in ids.items() if word not in special}
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    made = [ids[m.replace(" ", "", 1)] for m in merges]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    return {"ranks": ranks, "special": special}


def encoder(words: dict) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "byte_level", pat_str=PATTERN, mergeable_ranks=words["ranks"], special_tokens=words["special"]
    )


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; all but the first are full."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def pieces(
    docs: DataFrame,
    vocab_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(__id, __hash, piece, start, length, ids_crc32, __task, __rank) per piece.

    ``__rank`` counts the earlier pieces of the same length in the same task.
    """
    words = vocabulary(vocab_path)
    schema = pa.schema(
        [("__id", pa.int64()), ("__hash", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
         ("length", pa.int64()), ("ids_crc32", pa.int64()), ("__task", pa.int32()), ("__rank", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(words).encode
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc, mark, text in zip(*column_lists(batch)):
                ids = np.array([*encode(text, allowed_special="all"), end_id], "<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    row = (doc, mark, n, start, length, crc, task, int(seen[length]))
                    seen[length] += 1
                    for column, value in zip(out, row):
                        column.append(value)
            yield to_batch(schema, out)

    return texts(docs, id_col, text_col).mapInArrow(
        run,
        "__id long, __hash long, piece int, start long, length long, ids_crc32 long, __task int, __rank long",
    )


@dataclass(frozen=True)
class Slots:
    """Pieces of ``length`` with ranks from ``rank`` on lie at ``offset`` of the sequences
    from ``sequence`` on, ``count`` of them."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best fit, longest first, on the number of pieces of each length.

    A piece goes where the least room is left that takes it. After a piece, the same sequence
    has the least room for the next one of its length; so sequences of equal room are filled
    one after the other with as many as they take, all of them in one step.
    """
    # Runs of sequences with the same room, by room: (first sequence, number).
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    made: list[Slots] = []
    sequences = 0

    def put(free: int, first: int, number: int) -> None:
        if free and number:
            if not room.get(free):
                bisect.insort(rooms, free)
                room[free] = []
            room[free].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                free = rooms[at]
                first, number = room[free].pop()
                if not room[free]:
                    rooms.remove(free)
            else:
                # As many new sequences as the pieces that are left can use.
                free, first, number = capacity, sequences, -(-left // (capacity // length))
                sequences += number
            stack = free // length
            full = min(number, left // stack)
            rest = left - full * stack if full < number else 0
            for count, begin, pieces_each in ((full, first, stack), (1, first + full, rest)):
                for n in range(pieces_each if count else 0):
                    made.append(Slots(length, rank, count, begin, capacity - free + n * length))
                    rank += count
                    left -= count
                if pieces_each:
                    put(free - pieces_each * length, begin, count)
            used = full + (rest > 0)
            put(free, first + used, number - used)
    return made


def pack(
    docs: DataFrame,
    vocab_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, piece number, start, length, checksum and place.

    A NULL or empty text is one piece that holds the end id alone; repeated rows are packed
    as often as they occur. An empty table gives an empty one.
    """
    cutted = materialize(pieces(docs, vocab_path, capacity, end_id, id_col, text_col), "pieces").frame
    by_task = materialize(
        cutted.groupBy("length", "__task").agg(F.count("*").alias("__n")), "lengths"
    ).frame
    # Counts of lengths, of which there are at most ``capacity``.
    totals = by_task.groupBy("length").agg(F.sum("__n").alias("n")).collect()
    slots = plan({r["length"]: r["n"] for r in totals}, capacity)
    # Ranks of a length continue from task to task.
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select(
        "length", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from")
    )
    ranked = cutted.join(offsets, ["length", "__task"]).withColumn(
        "__rank", F.col("__rank") + F.col("__from")
    )
    starts: dict[int, tuple[np.ndarray, ...]] = {}
    for length in {s.length for s in slots}:
        own = [s for s in slots if s.length == length]
        starts[length] = tuple(
            np.array([getattr(s, part) for s in own], np.int64) for part in ("rank", "sequence", "offset")
        )
    keep = ["__id", "piece", "start", "length", "ids_crc32"]
    types = {"__id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for one in np.unique(length):
                here = length == one
                ranks, firsts, places = starts[int(one)]
                at = np.searchsorted(ranks, rank[here], side="right") - 1
                sequence[here] = firsts[at] + rank[here] - ranks[at]
                offset[here] = places[at]
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{n} {t}" for n, t in types.items()) + ", sequence_id long, offset long"
    return ranked.select(*keep, "__rank").mapInArrow(place, schema).select(
        true_id().alias("doc_id"), *keep[1:], "sequence_id", "offset"
    )
