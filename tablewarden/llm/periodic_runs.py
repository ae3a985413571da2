"""Periodic runs of words, found by uniting suffixes in order of decreasing common prefix.

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` words and
``MIN_PERIODS`` periods long, that no neighbouring word extends. Its first suffix and the one
q words later share all but q of its words, and no suffix between them shares as much: it
would give the stretch a smaller period. So if the suffixes of a text are united by
decreasing longest common prefix, the two become neighbours in the position order of their
class just when they are united. Each union looks at the newly neighbouring positions; a pair
whose distance is within the common prefix, and that the word before does not extend, is a
run. The smaller class is always put into the larger one.

Runs share ``DEEP`` words or more between the two suffixes, so uniting ends at that depth and
texts in which no stretch of ``DEEP`` words repeats are known to have none. Suffix order and
common prefixes come from prefix doubling with numpy, over many texts at once. Texts do not
depend on each other: nothing is shuffled, and a lost task is simply run again.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, to_batch

MIN_LENGTH = 24
MIN_PERIODS = 3
# Least common prefix of the two suffixes of a run: the least of max(MIN_LENGTH, MIN_PERIODS q) - q.
DEEP = min(max(MIN_LENGTH, MIN_PERIODS * q) - q for q in range(1, MIN_LENGTH + 1))
# Words that are ranked together; a longer text is ranked alone.
CHUNK_WORDS = 1 << 20
# Positions of a class are kept in blocks of at most this size.
BLOCK = 512
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)


class Positions:
    """An ordered set of positions."""

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, position: int) -> tuple[int | None, int | None]:
        """Insert a position and return its neighbours."""
        blocks = self.blocks
        n = bisect.bisect_left(blocks, position, key=_last) if len(blocks) > 1 else 0
        n = min(n, len(blocks) - 1)
        block = blocks[n]
        at = bisect.bisect_left(block, position)
        before = block[at - 1] if at else (blocks[n - 1][-1] if n else None)
        after = block[at] if at < len(block) else (blocks[n + 1][0] if n + 1 < len(blocks) else None)
        block.insert(at, position)
        if len(block) > BLOCK:
            blocks[n : n + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
        self.size += 1
        return before, after


def _last(block: list[int]) -> int:
    return block[-1]


def seeds(links: Iterable[tuple[int, int, int]], words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, distance) of the repeats that newly neighbouring positions form.

    ``links`` are (common prefix, suffix, suffix) with the longest prefixes first.
    """
    parent: dict[int, int] = {}
    held: dict[int, Positions] = {}
    for shared, a, b in links:
        roots = []
        for x in (a, b):
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            roots.append(root)
        small, large = sorted(roots, key=lambda r: held[r].size if r in held else 1)
        parent[small] = large
        into = held.get(large)
        if into is None:
            into = held[large] = Positions(large)
        mate = None
        for x in held.pop(small, (small,)):
            before, after = into.add(x)
            for start, next_one in ((before, x), (x, after)):
                # Members of one class were neighbours before.
                if start is None or next_one is None or start == mate:
                    continue
                distance = next_one - start
                if distance <= shared and (start == 0 or words[start - 1] != words[next_one - 1]):
                    yield start, shared + distance, distance
            mate = x


def _ranks(words: np.ndarray) -> list[np.ndarray]:
    """Classes of the stretches of 1, 2, 4 ... words, until all are different.

    A number is the place of the class in the order of stretches. ``words`` holds a number of
    its own behind each text, so no stretch that crosses an end equals another.
    """
    levels = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
    step, size = 1, len(words)
    while step < size and int(levels[-1].max()) + 1 < size:
        rank = levels[-1].astype(np.int64)
        ahead = np.zeros(size, np.int64)
        ahead[:-step] = rank[step:] + 1
        levels.append(np.unique(rank * (size + 1) + ahead, return_inverse=True)[1].astype(np.int32))
        step *= 2
    return levels


def _shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b``."""
    total = np.zeros(len(a), np.int64)
    size = len(levels[0])
    for n in range(len(levels) - 1, -1, -1):
        x, y = a + total, b + total
        inside = np.maximum(x, y) < size
        same = inside.copy()
        same[inside] = levels[n][x[inside]] == levels[n][y[inside]]
        total += same.astype(np.int64) << n
    return total


def _repeat_deep(words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Per text whether it may hold a stretch of ``DEEP`` words twice, by hash.

    Equal stretches have equal hashes, so no text with a repeat is missed.
    """
    value, length = words.astype(np.uint64) * HASH_STEP, 1
    while length < DEEP:
        step = min(length, DEEP - length)
        moved = np.zeros_like(value)
        moved[:-step] = value[step:]
        value = (value ^ (value >> np.uint64(31))) * HASH_STEP + moved
        length += step
    inside = np.flatnonzero(owner[: len(owner) - DEEP + 1] == owner[DEEP - 1 :])
    order = inside[np.argsort(value[inside])]
    twice = np.flatnonzero(value[order[1:]] == value[order[:-1]])
    found = np.zeros(texts, bool)
    found[owner[order[twice]]] = True
    return found


Run = tuple[int, int, int]


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """(start, length, period) of all runs of each text.

    Texts are given as numbers of words; no two texts may use the same number.
    """
    out: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.sum() < MIN_LENGTH:
        return out
    owner = np.repeat(np.arange(len(texts)), sizes)
    maybe = np.flatnonzero(_repeat_deep(np.concatenate(texts), owner, len(texts))).tolist()
    if not maybe:
        return out
    last = max(int(texts[n].max()) for n in maybe) + 1
    words = np.concatenate([x for k, n in enumerate(maybe) for x in (texts[n], np.array([last + k]))])
    begins = np.concatenate([[0], np.cumsum(sizes[maybe] + 1)])
    levels = _ranks(words)
    order = np.argsort(levels[-1])
    depth = _shared(levels, order[:-1], order[1:])
    del levels
    # Texts share no number, so suffixes with a common prefix are of one text.
    deep = np.flatnonzero(depth >= DEEP)
    owner = np.searchsorted(begins, order[deep], side="right") - 1
    ranked = np.lexsort((-depth[deep], owner))
    deep, owner = deep[ranked], owner[ranked]
    ends = np.searchsorted(owner, np.arange(len(maybe) + 1))
    for k, n in enumerate(maybe):
        links = deep[ends[k] : ends[k + 1]]
        a, b = (order[at] - begins[k] for at in (links, links + 1))
        found = seeds(zip(depth[links].tolist(), a.tolist(), b.tolist()), texts[n])
        out[n] = _whole_runs(found)
    return out


def _whole_runs(found: Iterator[Run]) -> list[Run]:
    """The runs among the repeats: long enough, and with the smallest period of the stretch.

    A repeat of three periods or more whose distance is not the smallest period covers just
    the stretch of the run with the smallest one.
    """
    least: dict[tuple[int, int], int] = {}
    for start, length, distance in found:
        if length >= max(MIN_LENGTH, MIN_PERIODS * distance):
            key = (start, length)
            least[key] = min(distance, least.get(key, distance))
    return sorted((start, length, period) for (start, length), period in least.items())


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return [words[n] for n in np.flatnonzero(kept).tolist()] if runs else words


def planted(doc: int | None, words: list[bytes]) -> list[bytes]:
    """The words, with a tail that repeats for one document in ten, as the number of the
    document says. A document without a number stays as it is."""
    if doc is None or not words:
        return words
    mark = zlib.crc32(str(doc).encode())
    if mark % 10:
        return words
    rest = mark // 10
    begin = rest % len(words)
    period = 1 + (len(words) - begin) // (3 + rest % 8)
    cycle = words[begin : begin + period]
    copies = -(-(len(words) - begin) // period)
    return words[:begin] + (cycle * copies)[: len(words) - begin]


def _numbers(batch: list[list[bytes]]) -> list[np.ndarray]:
    """The words as numbers; each text has numbers of its own."""
    out, base = [], 0
    for words in batch:
        known: dict[bytes, int] = {}
        out.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64) + base)
        base += len(known)
    return out


def find_runs(batch: list[list[bytes]]) -> Iterator[list[Run]]:
    """The runs of each list of words, in order; lists are ranked together up to a bound."""
    group: list[list[bytes]] = []
    size = 0
    for words in batch:
        if group and size + len(words) > CHUNK_WORDS:
            yield from runs_of(_numbers(group))
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield from runs_of(_numbers(group))


SPANS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) per row: its runs of words and its text without the repeats.

    Words are what stands between ASCII white space. A NULL or empty text has no runs and
    an empty text left; a NULL id stays NULL; repeated rows give repeated results.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = column_lists(batch)
            words = [t.encode().split() for t in text]
            runs = list(find_runs(words))
            left = [b" ".join(without_repeats(w, r)).decode() for w, r in zip(words, runs)]
            rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
            yield to_batch(schema, [doc, rows, left])

    return _slim(docs, id_col, text_col).mapInArrow(find, f"doc_id long, runs {SPANS}, collapsed string")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period; then the least start, then the least period."""
    best = None
    for run in sorted(runs):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def run_report(docs: DataFrame) -> DataFrame:
    """Per row the number of runs, the strongest one, and SHA-256 of all runs and of the words left.

    The words of one document in ten are made to repeat first, as ``planted`` says. NULL and
    empty texts have no run: no run means 0, NULL for the strongest one, and the digest of
    nothing. An empty table gives an empty one.
    """
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
        + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    )

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = column_lists(batch)
            words = [planted(d, t.encode().split()) for d, t in zip(doc, text)]
            out: list[list] = [[] for _ in schema]
            for d, w, runs in zip(doc, words, find_runs(words)):
                best = strongest(runs) or (None, None, None)
                milli = 1000 * best[1] // best[2] if runs else None
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
                digests = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(without_repeats(w, runs)))]
                for column, value in zip(out, (d, len(runs), *best, milli, *digests)):
                    column.append(value)
            yield to_batch(schema, out)

    types = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)
    return _slim(docs, "doc_id", "text").mapInArrow(report, types)
