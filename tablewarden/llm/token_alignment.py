"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked tokens.

Both tokenizers tile the same bytes. Where tokens of both end, the text is cut into groups;
two tokens whose bytes overlap are linked, once for each stretch between neighbouring ends.
The count of a pair of ids is the number of documents in which they are linked.

Texts are encoded once and their ids written. A first pass gathers the distinct pairs, which
get a minimal perfect hash. A task then counts into a dense vector with one number per pair,
and the vectors are summed in a tree of bounded width. The last pass aligns the documents
again and looks the counts up; a pair's index holds its key, so that a pair is never taken
for another. Tasks hold one block of pairs at a time; with more pairs the two passes over the
documents are made once per block, and what a block adds to a document is summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm import perfect_hash
from tablewarden.llm.common import column_lists, to_batch
from tablewarden.llm.packing import encoder, vocabulary
from tablewarden.materialize import materialize

# Bytes of documents that are aligned together; a longer one is aligned alone.
CHUNK_BYTES = 1 << 18
# Rows that are taken out of a batch at a time.
ROWS = 256
# Distinct pairs that a task gathers before it sends them on.
TASK_PAIRS = 1 << 20
# Counts in a row of a vector, and vectors that are added up by one task.
ROW_COUNTS = 1 << 13
FAN_IN = 16
SHIFT = 32


@dataclass
class Side:
    """Bytes and byte lengths of a tokenizer's ids."""

    bytes: list[bytes]
    length: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Side:
        return cls(tokens, np.array([len(t) for t in tokens], np.int64))

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def byte_side(words: dict) -> Side:
    """The ids of a byte-level vocabulary; special tokens are their own text."""
    tokens = [b""] * (1 + max([*words["ranks"].values(), *words["special"].values()]))
    for word, n in words["ranks"].items():
        tokens[n] = word
    for word, n in words["special"].items():
        tokens[n] = word.encode()
    return Side.of(tokens)


def piece_side(model: sentencepiece.SentencePieceProcessor) -> Side:
    """The ids of a piece model: U+2581 is a blank, a byte piece its byte."""
    tokens = []
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        tokens.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(n) else piece.replace("▁", " ").encode())
    return Side.of(tokens)


def id_type(sides: tuple[Side, Side]) -> str:
    """How ids are written: in two bytes if they fit."""
    return "<u2" if max(len(s.bytes) for s in sides) <= 1 << 16 else "<u4"


TOKENS = pa.schema([("__row", pa.int64()), ("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def encode(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__row, doc_id, a, b) per row: the ids of both tokenizers, each of ``id_type``.

    Both are empty for a NULL or empty text, and for one that either tokenizer does not
    give back byte by byte.
    """
    words = vocabulary(byte_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = encoder(words), sentencepiece.SentencePieceProcessor(model_file=piece_path)
        sides = byte_side(words), piece_side(second)
        kind = id_type(sides)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                doc, text = column_lists(batch.slice(at, ROWS))
                out: list[list] = [list(range(row, row + len(doc))), doc, [], []]
                row += len(doc)
                for one, pieces in zip(text, second.encode(text, num_threads=1)):
                    ids = first.encode_ordinary(" " + one) if one else [], pieces
                    whole = b" " + one.encode()
                    if any(side.joined(i) != whole for side, i in zip(sides, ids)):
                        ids = [], []
                    for column, value in zip(out[2:], ids):
                        column.append(np.array(value, kind).tobytes())
                yield to_batch(TOKENS, out)

    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return slim.mapInArrow(run, "__row long, doc_id long, a binary, b binary")


@dataclass
class Aligned:
    """Documents aligned together, one behind the other.

    ``a`` and ``b`` are ids, ``a_group`` and ``b_group`` the groups they are in, ``a_upto``
    and ``b_upto`` the tokens up to the end of each group; ``link_a``, ``link_b`` the places
    of linked tokens and ``link_doc`` the document of a link. The others are per document.
    """

    a: np.ndarray
    b: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    links: np.ndarray
    groups: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_upto: np.ndarray
    b_upto: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_doc: np.ndarray

    def keys(self) -> np.ndarray:
        return (self.a[self.link_a] << SHIFT) | self.b[self.link_b]

    def index(self, table: perfect_hash.Table) -> np.ndarray:
        """Index of the pair of each link, -1 if it is in another block."""
        keys, place = np.unique(self.keys(), return_inverse=True)
        return table.index(keys)[place]


def align(a_lists: list[np.ndarray], b_lists: list[np.ndarray], sides: tuple[Side, Side]) -> Aligned:
    a_counts, b_counts = (np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
    a, b = (np.concatenate(lists).astype(np.int64) for lists in (a_lists, b_lists))
    # Both sides of a document have the same bytes, so their ends meet at its end.
    a_ends, b_ends = np.cumsum(sides[0].length[a]), np.cumsum(sides[1].length[b])
    marks = np.zeros(1 + (int(a_ends[-1]) if len(a) else 0), np.uint8)
    marks[a_ends] = 1
    marks[b_ends] += 2
    # One link for each stretch between neighbouring ends.
    ends = np.flatnonzero(marks)
    kind = marks[ends]
    of_a, of_b, both = kind & 1 == 1, kind & 2 == 2, kind == 3
    a_done, b_done, done = (np.cumsum(x) for x in (of_a, of_b, both))
    group = done - both
    upto = np.searchsorted(ends, np.concatenate([[0], a_ends])[np.cumsum(a_counts)], side="right")
    links = np.diff(upto, prepend=0)
    groups = np.diff(np.concatenate([[0], done])[upto], prepend=0)
    return Aligned(
        a, b, a_counts, b_counts, links, groups, group[of_a], group[of_b], a_done[both], b_done[both],
        a_done - of_a, b_done - of_b, np.repeat(np.arange(len(links)), links),
    )


class Printer:
    """Writes groups as text: ids of the first side, ``|``, ids of the second, ``;``."""

    def __init__(self, sides: tuple[Side, Side]):
        width = 1 + len(str(max(len(s.bytes) for s in sides)))
        self.tables = [
            [np.array([f"{n}{mark}" for n in range(len(side.bytes))], f"S{width}") for mark in marks]
            for side, marks in zip(sides, (",|", ",;"))
        ]

    def texts(self, x: Aligned) -> Iterator[bytes]:
        """The groups of each document, empty for one without tokens."""
        b_before = np.concatenate([[0], x.b_upto])[:-1]
        out = np.empty(len(x.a) + len(x.b), self.tables[0][0].dtype)
        for side, (ids, group, ends, shift) in enumerate(
            ((x.a, x.a_group, x.a_upto, b_before), (x.b, x.b_group, x.b_upto, x.a_upto))
        ):
            here = np.arange(len(ids))
            inner, last = self.tables[side]
            out[here + shift[group]] = np.where(here + 1 == ends[group], last[ids], inner[ids])
        ends = np.cumsum(x.a_counts + x.b_counts)
        for begin, end in zip((ends - x.a_counts - x.b_counts).tolist(), ends.tolist()):
            yield out[begin:end].tobytes().replace(b"\0", b"")[:-1]


def chunks(
    batches: Iterator[pa.RecordBatch], sides: tuple[Side, Side]
) -> Iterator[tuple[list[int], list[int | None], Aligned]]:
    """(rows, doc_ids, their alignment) of documents in portions of bounded size."""
    kind = id_type(sides)
    rows, ids, a, b, size = [], [], [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            for row, doc, x, y in zip(*column_lists(batch.slice(at, ROWS))):
                if rows and size + len(x) > CHUNK_BYTES:
                    yield rows, ids, align(a, b, sides)
                    rows, ids, a, b, size = [], [], [], [], 0
                rows.append(row)
                ids.append(doc)
                a.append(np.frombuffer(x, kind))
                b.append(np.frombuffer(y, kind))
                size += len(x)
    if rows:
        yield rows, ids, align(a, b, sides)


def distinct_pairs(tokens: DataFrame, sides: tuple[Side, Side]) -> DataFrame:
    """(key) of the pairs linked anywhere, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for _, _, x in chunks(batches, sides):
            found.append(np.unique(x.keys()))
            if sum(map(len, found)) >= TASK_PAIRS:
                found = [np.unique(np.concatenate(found))]
                if 2 * len(found[0]) >= TASK_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(found.pop())], ["key"])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["key"])

    return tokens.mapInArrow(run, "key long").distinct()


VECTOR = pa.schema([("chunk", pa.int32()), ("node", pa.int64()), ("counts", pa.list_(pa.int64()))])
VECTOR_TYPES = "chunk int, node long, counts array<bigint>"


def _rows_of(vector: np.ndarray, node: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(vector), ROW_COUNTS):
        part = vector[at : at + ROW_COUNTS]
        if part.any():
            yield to_batch(VECTOR, [[at // ROW_COUNTS], [node], [part]])


def count_documents(tokens: DataFrame, table: perfect_hash.Table, sides: tuple[Side, Side]) -> DataFrame:
    """(chunk, node, counts): how many documents link each pair of the block, by its index."""
    size = len(table.keys)
    held = tokens.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, np.int64)
        for _, _, x in chunks(batches, sides):
            index = x.index(held.value)
            inside = index >= 0
            once = np.unique(x.link_doc[inside] * size + index[inside]) % max(1, size)
            np.add.at(vector, once, 1)
        yield from _rows_of(vector, TaskContext.get().partitionId())

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for counts in batch.column("counts"):
                one = counts.values.to_numpy()
                total = one.copy() if total is None else total + one
        yield to_batch(VECTOR, [[key[0].as_py()], [key[1].as_py()], [total]])

    parts = materialize(tokens.mapInArrow(run, VECTOR_TYPES), "vectors", top=F.max("node"))
    held.unpersist()
    frame, nodes = parts.frame, (parts.metrics["top"] or 0) + 1
    while nodes > 1:
        above = frame.withColumn("node", F.expr(f"node div {FAN_IN}"))
        frame = above.groupBy("chunk", "node").applyInArrow(add, VECTOR_TYPES)
        nodes = -(-nodes // FAN_IN)
    return materialize(frame, "counts").frame


def dense(counted: DataFrame, size: int) -> np.ndarray:
    """The counts of a block as one vector."""
    total = np.zeros(size, np.int64)
    for r in counted.toLocalIterator():
        begin = r["chunk"] * ROW_COUNTS
        total[begin : begin + len(r["counts"])] = r["counts"]
    return total


REPORT = pa.schema(
    [("__row", pa.int64())]
    + [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)
REPORT_TYPES = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in REPORT)


def _look_up(
    tokens: DataFrame, table: perfect_hash.Table, counts: np.ndarray, best: np.ndarray, sides: tuple[Side, Side], whole: bool
) -> DataFrame:
    """Per row what the block's pairs add to it; with ``whole`` also all else of the report."""
    held = tokens.sparkSession.sparkContext.broadcast((table, counts, counts == best[table.keys >> SHIFT]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts, top = held.value
        printer = Printer(sides) if whole else None
        for rows, ids, x in chunks(batches, sides):
            index = x.index(table)
            inside = index >= 0
            doc, index = x.link_doc[inside], index[inside]
            n_best = np.bincount(doc[top[index]], minlength=len(rows))
            total = np.zeros(len(rows), np.int64)
            np.add.at(total, doc, counts[index])
            if whole:
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in printer.texts(x)]
                rest = [ids, x.a_counts, x.b_counts, x.groups, x.links]
            else:
                digests, rest = [None] * len(rows), [[None] * len(rows)] * 5
            yield to_batch(REPORT, [rows, *rest, n_best, total, digests])

    return tokens.mapInArrow(run, REPORT_TYPES)


def alignment_report(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per row of ``docs``: tokens of both sides, groups, links, and what the counts say of them.

    ``n_best`` counts the links whose pair has the highest count of its first id, ties
    included; ``count_sum`` adds the counts of all links. Each row is a document: repeated
    rows count as often as they occur. A NULL or empty text, and one that a tokenizer
    changes, has zeros and an empty digest; a NULL id stays NULL; an empty table gives an
    empty one. Special tokens in a text are plain text.
    """
    words = vocabulary(byte_path)
    sides = byte_side(words), piece_side(sentencepiece.SentencePieceProcessor(model_file=piece_path))
    tokens = materialize(encode(docs, byte_path, piece_path), "tokens").frame
    pairs = materialize(distinct_pairs(tokens, sides), "pairs")
    hashed = perfect_hash.build(pairs.frame, pairs.rows)
    # Highest count of each first id; the driver holds one block of pairs at a time.
    best = np.zeros(len(sides[0].bytes), np.int64)
    counted = []
    for n in range(len(hashed.blocks)):
        table = hashed.block(n)
        counted.append(count_documents(tokens, table, sides))
        np.maximum.at(best, table.keys >> SHIFT, dense(counted[n], len(table.keys)))
    reports = []
    for n, frame in enumerate(counted):
        table = hashed.block(n)
        report = _look_up(tokens, table, dense(frame, len(table.keys)), best, sides, n == 0)
        if len(counted) == 1:
            return report.drop("__row")
        reports.append(materialize(report, "looked_up").frame)
    both = reduce(DataFrame.unionByName, reports).groupBy("__row")
    sums = ("n_best", "count_sum")
    return both.agg(*[(F.sum if c in sums else F.max)(c).alias(c) for c in REPORT.names[1:]]).drop("__row")
