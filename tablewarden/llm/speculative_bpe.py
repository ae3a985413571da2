"""Byte-pair encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest tokens. That proposal is the byte-pair encoding
exactly if each two neighbouring tokens, merged by themselves, stay apart. All pairs of the
words of a batch are tested at once: a pair is walked back in time, undoing the later of the
two last merges at each step, and fails if ever a merge across the boundary would have come
before the merges that took its sides away. Only the words with a failing pair are merged
step by step.

Each word is encoded once per task as long as its cache holds it; documents do not depend on
each other, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, to_batch
from tablewarden.llm.packing import PATTERN, byte_of_letter

# Words that a task remembers; a full memory is emptied.
CACHE_WORDS = 1 << 18
# Words of documents that are encoded together, and characters of a text that are split at a time.
CHUNK_WORDS = 1 << 18
CHUNK_CHARS = 1 << 20
# Longest word that is merged by looking through all its pairs for the least rank.
SHORT = 64
NEVER = 1 << 40
# A blank between two other characters always begins a word.
SAFE = regex.compile(r"(?<=\S) (?=\S)")


class Codec:
    """Encodes and decodes with a byte-level vocabulary file.

    The file must make every token of several bytes by one merge, of parts that are made
    earlier; anything else is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_of_letter()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for word, n in vocab.items():
            if word not in self.special:
                self.bytes[n] = bytes(letters[c] for c in word)
        self.size = size
        self._take_merges(path, vocab, spec["model"]["merges"])
        for word, n in self.special.items():
            self.bytes[n] = word.encode()
        own = [n for word, n in vocab.items() if word not in self.special]
        stays = self._reachable(np.array(own))
        self.ids = {self.bytes[n]: n for n, good in zip(own, stays) if good}
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing:
            raise ValueError(f"{path}: no token for the bytes {missing}")
        # Longest token by its first two bytes.
        self.longest: dict[bytes, int] = {}
        for word in self.ids:
            self.longest[word[:2]] = max(len(word), self.longest.get(word[:2], 0))
        self.words = regex.compile(PATTERN)
        by_length = sorted(self.special, key=len, reverse=True)
        self.cuts = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.cache: dict[str, bytes] = {}

    def _take_merges(self, path: str, vocab: dict[str, int], merges: list) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        at = np.arange(len(pairs))
        # Order in which tokens are made; bytes are there from the start.
        self.born = np.full(self.size, -1, np.int64)
        self.born[made] = at
        early = (self.born[left] < at) & (self.born[right] < at)
        if len(np.unique(made)) != len(made) or not early.all():
            raise ValueError(f"{path}: tokens are not made by one merge each, in order")
        self.left, self.right = np.zeros((2, self.size), np.int64)
        self.left[made], self.right[made] = left, right
        keys = left * self.size + right
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[order], at[order]
        self.ranks = {pair: n for n, pair in enumerate(zip(left.tolist(), right.tolist()))}
        self.made = made.tolist()

    def _merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], 2 * NEVER)

    def stay_apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge ever crosses from token ``a`` to a following token ``b``.

        ``until`` is the time at which both are taken by a merge of their own, if ever.
        At equal rank the merge further left comes first: one inside ``a`` goes before one
        across, which goes before one inside ``b``.
        """
        good = np.ones(len(a), bool)
        row = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_gone = np.full(len(a), NEVER) if until is None else until.astype(np.int64)
        y_gone = x_gone - 1 if until is not None else x_gone.copy()
        while len(row):
            rank = self._merge_rank(x, y)
            crossed = (rank < x_gone) & (rank <= y_gone)
            good[row[crossed]] = False
            born_x, born_y = self.born[x], self.born[y]
            left = ~crossed & (np.maximum(born_x, born_y) >= 0)
            undo_y = born_y >= born_x
            x_gone, y_gone = np.where(undo_y, x_gone, born_x), np.where(undo_y, born_y, y_gone)
            x, y = np.where(undo_y, x, self.right[x]), np.where(undo_y, self.left[y], y)
            row, x, y, x_gone, y_gone = (v[left] for v in (row, x, y, x_gone, y_gone))
        return good

    def _reachable(self, tokens: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a token gives that token."""
        good = np.ones(self.size, bool)
        made = tokens[self.born[tokens] >= 0]
        made = made[np.argsort(self.born[made])]
        good[made] = self.stay_apart(self.left[made], self.right[made], self.born[made])
        for n in made.tolist():
            good[n] &= good[self.left[n]] and good[self.right[n]]
        return good[tokens]

    def propose(self, word: bytes) -> list[int]:
        """The longest token at each place."""
        ids, longest = self.ids, self.longest
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        out, at, end = [], 0, len(word)
        while at < end:
            for stop in range(min(end, at + longest.get(word[at : at + 2], 1)), at, -1):
                n = ids.get(word[at:stop])
                if n is not None:
                    break
            out.append(n)
            at = stop
        return out

    def merge(self, word: bytes) -> list[int]:
        """The encoding by single merges, the least rank first and of equal ones the leftmost."""
        ids = [self.ids[word[n : n + 1]] for n in range(len(word))]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < NEVER:
            at = ranks.index(rank)
            ids[at : at + 2] = [made[rank]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of the pairs."""
        rank_of, made, span = self.ranks.get, self.made, len(ids)
        after = list(range(1, span + 1))
        before = list(range(-1, span - 1))
        heap = [
            rank * span + n for n, pair in enumerate(zip(ids, ids[1:])) if (rank := rank_of(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, n = divmod(heapq.heappop(heap), span)
            other = after[n]
            # A pair of which a part was merged since is out of date.
            if ids[n] < 0 or other >= span or rank_of((ids[n], ids[other])) != rank:
                continue
            ids[n], ids[other] = made[rank], -1
            after[n] = after[other]
            if after[n] < span:
                before[after[n]] = n
            for first, second in ((before[n], n), (n, after[n])):
                if first >= 0 and second < span:
                    found = rank_of((ids[first], ids[second]))
                    if found is not None:
                        heapq.heappush(heap, found * span + first)
        return [n for n in ids if n >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words had to be merged step by step."""
        found = [self.propose(word) for word in words]
        sizes = np.array([len(f) for f in found], np.int64)
        flat = np.fromiter((n for f in found for n in f), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.stay_apart(pairs // self.size, pairs % self.size)
        failed = np.unique(owner[inner[~good[place]]]).tolist()
        for n in failed:
            found[n] = self.merge(words[n])
        return found, len(failed)

    def split(self, text: str) -> Iterator[list[str] | int]:
        """Words of a text in lists of bounded length, and the ids of special tokens."""
        at = 0
        for cut in self.cuts.finditer(text) if self.cuts else ():
            yield from self._split_plain(text, at, cut.start())
            yield self.special[cut.group()]
            at = cut.end()
        yield from self._split_plain(text, at, len(text))

    def _split_plain(self, text: str, at: int, end: int) -> Iterator[list[str]]:
        while at < end:
            cut = SAFE.search(text, at + CHUNK_CHARS, end) if end - at > CHUNK_CHARS else None
            stop = cut.start() if cut else end
            yield self.words.findall(text, at, stop)
            at = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str] | int]] = []
        size = 0
        for n, text in enumerate(texts):
            for part in self.split(text):
                waiting.append((n, part))
                size += len(part) if isinstance(part, list) else 1
                if size >= CHUNK_WORDS:
                    self._flush(waiting, out)
                    waiting, size = [], 0
        self._flush(waiting, out)
        return [b"".join(parts) for parts in out]

    def _flush(self, waiting: list[tuple[int, list[str] | int]], out: list[list[bytes]]) -> None:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache = self.cache
        fresh = list({word for _, part in waiting if isinstance(part, list) for word in part if word not in cache})
        found, _ = self.encode_words([word.encode() for word in fresh])
        data, at = np.array([n for ids in found for n in ids], "<u4").tobytes(), 0
        for word, ids in zip(fresh, found):
            end = at + 4 * len(ids)
            cache[word] = data[at:end]
            at = end
        for n, part in waiting:
            if isinstance(part, list):
                out[n].append(b"".join(map(cache.__getitem__, part)))
            else:
                out[n].append(np.array([part], "<u4").tobytes())

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(table.__getitem__, numbers)).decode("utf-8", "replace")


def encode_documents(
    docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, ids) per row of ``docs``, the ids as little-endian unsigned 32-bit numbers."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocab_path)
        for batch in batches:
            doc, text = column_lists(batch)
            yield to_batch(schema, [doc, codec.encode(text)])

    return _slim(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, text) per row of (doc_id, ids)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocab_path)
        for batch in batches:
            doc, ids = column_lists(batch)
            yield to_batch(schema, [doc, [codec.decode(i or b"") for i in ids]])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def round_trip_report(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Per row: number of tokens, SHA-256 of the ids and of the text decoded from them.

    Each row is encoded and decoded in one pass. A NULL text counts as empty and has no
    tokens; a NULL id stays NULL; repeated rows give repeated results; an empty table gives
    an empty one. A text is never cut: a long one is split into words part by part, at
    blanks where a word begins anyway.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocab_path)
        for batch in batches:
            doc, text = column_lists(batch)
            ids = codec.encode(text)
            yield to_batch(
                schema,
                [
                    doc,
                    [len(i) // 4 for i in ids],
                    [hashlib.sha256(i).hexdigest() for i in ids],
                    [hashlib.sha256(codec.decode(i).encode()).hexdigest() for i in ids],
                ],
            )

    return _slim(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
