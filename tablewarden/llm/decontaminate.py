"""Benchmark passages in documents by the q-gram lemma.

Benchmark items are cut into overlapping pieces. A region of a document that lies within
``k`` edits of a piece of ``m`` characters shares at least ``m - q + 1 - k * q`` of its
q-grams, all near one diagonal: the place in the document less the place in the piece.
Shared q-grams are counted per piece in overlapping bands of diagonals, bands that reach the
bound are retained, and the region is verified by an alignment within the band.

Before that, a stretch of a document that has too few q-grams of the whole benchmark cannot
reach the bound with any piece and is passed over; no match is lost by it.

The index of q-grams is sent to the executors in blocks of bounded size, a benchmark of any
size takes as many passes as it has blocks. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, keyed, texts, to_batch, true_id, unkeyed
from tablewarden.materialize import materialize

Q = 8
# Length of a piece, distance of the next one, and the share of it that may be edited. A run of
# ``PIECE`` exact characters lies at most half a stride from a piece, which is within its edits.
PIECE, STRIDE, EDITS = 64, 10, 0.08  # at most 64, the places are packed in six bits
# Characters of benchmark text in one block of the index; each lies in six or seven pieces.
BLOCK_CHARS = 1_250_000
BITS = 20
# Pairs of a place in a text and a q-gram of a piece that are held at a time, about.
PAIRS = 1 << 20


def normalise(text: str | None) -> str:
    """Lower case, one space between words."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    """One byte per character; rare characters share one, which only adds candidates."""
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Eight characters from each place on, as one number."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    one = codes.astype(np.uint64)
    two = one[:-1] | (one[1:] << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    return four[:-4] | (four[4:] << np.uint64(32))


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


@dataclass(frozen=True)
class Index:
    """Pieces of benchmark items and their q-grams, sorted."""

    items: list[int | None]
    pieces: list[str]
    edits: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    known: np.ndarray
    # Fewest q-grams that any piece needs, and the longest stretch that one can align with.
    least: int
    reach: int


def build_index(items: list[tuple[int | None, str | None]]) -> Index:
    """Items of fewer than ``Q`` characters are too short to be told from chance."""
    owners, pieces = [], []
    for item, text in items:
        text = normalise(text)
        if len(text) < Q:
            continue
        last = max(0, len(text) - PIECE)
        # Equal pieces of an item would be found at the same places.
        for piece in dict.fromkeys(text[at : at + PIECE] for at in sorted({*range(0, last, STRIDE), last})):
            owners.append(item)
            pieces.append(piece)
    lengths = np.array([len(p) for p in pieces], np.int64)
    edits = np.minimum((lengths * EDITS).astype(np.int64), (lengths - Q) // Q)
    found = [_grams(_codes(p)) for p in pieces]
    grams = np.concatenate([*found, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(pieces)), [len(g) for g in found])
    place = np.concatenate([*(np.arange(len(g)) for g in found), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(grams, kind="stable")
    known = np.zeros(1 << BITS, bool)
    known[_slot(grams)] = True
    needed = lengths - Q + 1 - edits * Q
    least, reach = int(needed.min(initial=PIECE)), int((lengths + edits).max(initial=0))
    return Index(
        owners, pieces, edits, needed, grams[order], owner[order], place[order], known, least, reach
    )


def align(piece: str, region: str, band: int) -> tuple[int, int, int]:
    """(edits, start, end) of the best place for all of ``piece`` within ``region``.

    Only cells within ``band`` of the middle diagonal are filled; ``region`` begins ``band``
    characters before the place where the piece would lie without edits.
    """
    far = len(piece) + len(region) + 1
    width = 2 * band + 1
    cost = [0] * width
    start = list(range(width))
    for i, letter in enumerate(piece):
        new_cost, new_start = [far] * width, [0] * width
        for d in range(width):
            j = i + d
            best, origin = far, 0
            if j < len(region):
                best, origin = cost[d] + (region[j] != letter), start[d]
            if d + 1 < width and cost[d + 1] + 1 < best:
                best, origin = cost[d + 1] + 1, start[d + 1]
            if d and j <= len(region) and new_cost[d - 1] + 1 < best:
                best, origin = new_cost[d - 1] + 1, new_start[d - 1]
            new_cost[d], new_start[d] = best, origin
        cost, start = new_cost, new_start
    d = min(range(width), key=lambda x: (cost[x], abs(x - band)))
    return cost[d], start[d], min(len(region), len(piece) + d)


def _candidates(index: Index, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(piece, first diagonal, last diagonal) of the bands that reach the bound."""
    grams = _grams(codes)
    if not len(grams) or not index.pieces:
        return []
    hit = index.known[_slot(grams)]
    span = index.reach
    total = np.r_[0, np.cumsum(hit)]
    ends = np.minimum(np.arange(len(grams)) + span, len(grams))
    rich = np.flatnonzero(total[ends] - total[:-1] >= index.least)
    if not len(rich):
        return []
    near = np.zeros(len(grams) + 1, np.int64)
    np.add.at(near, rich, 1)
    np.add.at(near, ends[rich], -1)
    at = np.flatnonzero(hit & (np.cumsum(near)[:-1] > 0))
    low = np.searchsorted(index.grams, grams[at], "left")
    many = np.searchsorted(index.grams, grams[at], "right") - low
    # A band lies within this many places, so portions that overlap by them lose none.
    overlap = span + 2 * (int(index.edits.max()) + 1)
    found: set[tuple[int, int, int]] = set()
    done = np.r_[0, np.cumsum(many)]
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + PAIRS, "right")) - 1)
        stop = max(end, int(np.searchsorted(at, at[end - 1] + overlap, "right")))
        one = slice(begin, stop)
        _count_bands(index, at[one], low[one], many[one], found)
        if stop == len(at):
            break
        begin = end
    return sorted(found)


def _count_bands(
    index: Index, at: np.ndarray, low: np.ndarray, many: np.ndarray, found: set[tuple[int, int, int]]
) -> None:
    """Add the bands in which a piece has enough q-grams among those at the places ``at``."""
    entry = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
    piece = index.owner[entry]
    # A piece with too few q-grams at all these places has too few in any band.
    rich = np.bincount(piece, minlength=len(index.pieces))[piece] >= index.needed[piece]
    if not rich.any():
        return
    entry, piece = entry[rich], piece[rich]
    place = index.place[entry]
    diagonal = np.repeat(at, many)[rich] - place
    step = index.edits[piece] + 1
    for shift in (0, 1):
        band = diagonal // step - shift
        # A q-gram of the piece counts once in a band, however often the band has it.
        key = np.unique((piece << 40 | (band + (1 << 31))) << 6 | place)
        region = key >> 6
        first = np.flatnonzero(np.r_[True, region[1:] != region[:-1]])
        counts = np.diff(np.r_[first, len(key)])
        pieces = region[first] >> 40
        for n in np.flatnonzero(counts >= index.needed[pieces]):
            p, b = int(pieces[n]), int(region[first[n]] & ((1 << 40) - 1)) - (1 << 31)
            found.add((p, b * int(index.edits[p] + 1), (b + 2) * int(index.edits[p] + 1) - 1))


def matches(index: Index, text: str | None) -> list[tuple[int | None, int, int, int]]:
    """(item, start, end, edits) of the benchmark passages in a text, over its normal form.

    Touching pieces of one item are one passage; ``edits`` is that of its worst piece.
    """
    normal = normalise(text)
    spans: dict[int | None, list[tuple[int, int, int]]] = {}
    for piece, low, high in _candidates(index, _codes(normal)):
        wanted = index.pieces[piece]
        middle = (low + high) // 2
        band = (high - low) // 2 + 1 + int(index.edits[piece])
        exact = normal.find(wanted, max(0, low), max(0, high) + len(wanted))
        if exact >= 0:
            edits, start, end = 0, exact, exact + len(wanted)
        else:
            # Blanks that match nothing stand for what lies before the text.
            lead = max(0, band - middle)
            region = "\0" * lead + normal[max(0, middle - band) : middle + len(wanted) + band]
            edits, start, end = align(wanted, region, band)
            start, end = max(0, middle - band + start), middle - band + end
        if edits <= index.edits[piece]:
            spans.setdefault(index.items[piece], []).append((start, end, edits))
    merged = []
    for item, found in spans.items():
        run: list[int] = []
        for start, end, edits in sorted(found):
            if run and start <= run[1]:
                run[1], run[2] = max(run[1], end), max(run[2], edits)
            else:
                run = [start, end, edits]
                merged.append((item, run))
    return [(item, *run) for item, run in merged]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """The index in blocks of at most about ``BLOCK_CHARS`` characters."""
    size = benchmark.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
    count = -(-size // BLOCK_CHARS)
    for block in range(count):
        mine = benchmark.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(count)) == block)
        rows = mine.select(F.col(id_col).cast("long"), F.col(text_col)).distinct().collect()
        items = [(r[0], r[1] or "") for r in rows]
        yield build_index(sorted(items, key=lambda i: (i[0] is None, i[0] or 0, i[1])))


FOUND = "__id long, __hash long, item_id long, start long, end long, edits int"


def _search(rows: DataFrame, index: Index) -> DataFrame:
    """The passages of one block, written, so that its index need not be kept."""
    schema = pa.schema(
        [("__id", pa.int64()), ("__hash", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
         ("end", pa.int64()), ("edits", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc, mark, text in zip(*column_lists(batch)):
                for match in matches(index, text):
                    for column, value in zip(out, (doc, mark, *match)):
                        column.append(value)
            yield to_batch(schema, out)

    return materialize(rows.mapInArrow(run, FOUND), "passages").frame


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(__id, __hash, item_id, start, end, edits) per benchmark passage in a document.

    NULL and empty texts have none, and items of fewer than eight characters are not looked
    for. Items without an id are found under a NULL ``item_id``. Places count characters of
    the normal form. Rows that repeat a document repeat its passages; items that repeat id
    and text are one. An empty benchmark gives an empty table.
    """
    rows = texts(docs, id_col, text_col)
    found = None
    for index in _blocks(benchmark, item_id, item_text):
        block = _search(rows, index)
        del index  # before the next block is collected
        found = block if found is None else found.unionByName(block)
    return rows.sparkSession.createDataFrame([], FOUND) if found is None else found


def passage_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per benchmark passage found; documents without one have no row."""
    return find_passages(docs, benchmark).select(
        true_id().alias("doc_id"), "item_id", "start", "end", "edits"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage."""
    bad = materialize(find_passages(docs, benchmark).select("__id", "__hash").distinct(), "bad").frame
    return unkeyed(keyed(docs).join(bad.hint("merge"), ["__id", "__hash"], "left_anti"), docs)
