"""Personal data: exact base patterns, and a character tagger that finds more.

The tagger (``tagger``) learns from spans of the base patterns in a bounded sample of
documents, together with variants of them that the patterns do not cover. It reads every text
in overlapping windows. Where windows overlap, a character gets its label from the window in
which it lies further inside, and spans are joined over the whole text from these labels, so
one that crosses the edge of a window is found whole.

A span must contain the character without which its kind cannot be (``@`` in an address, a
digit in a number). A window without any of these cannot give a span and is not decoded;
the result is the same as if it were.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm import tagger
from tablewarden.llm.common import column_lists, to_batch
from tablewarden.materialize import materialize

KINDS = tagger.KINDS
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# An address is four parts of a chain of numbers; chains are found in one pass over the text.
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
ANCHOR = re.compile("[0-9@]")
# What a text with a span of each kind is likely to match, in bounded steps from any place.
LIKELY = (
    r"[A-Za-z0-9]@[A-Za-z0-9-]{1,60}\.",
    r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]",
    r"[0-9](?:[ -]?[0-9]){15}",
    r"\+[0-9][ ().0-9-]{6}",
)
# Windows and how far they overlap; a label counts at least half the overlap from an edge.
WINDOW, OVERLAP = 160, 64
TRAIN_WINDOW = 96
# Documents that the tagger learns from at most, and windows of each.
TRAIN_DOCS, TRAIN_WINDOWS = 1_500, 8

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``EMAIL``. Each holds exactly one ``@`` behind its longest local part, so
    only places before an ``@`` are tried."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts of a chain, from its first on, that are at most 255."""
    for m in CHAIN.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for n in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[n : n + 4])) + 3
            plain = [p.lstrip("0") or "0" for p in parts[n : n + 4]]
            if all(len(p) <= 3 and int(p) <= 255 for p in plain):
                yield at, end
            at = end + 1


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) of the base patterns, by kind and place."""
    text = text or ""
    found = [(0, *span) for span in _emails(text)]
    if DIGIT.search(text) is None:
        return found
    found += [(1, *span) for span in _addresses(text)]
    for m in CARD.finditer(text):
        number = _digits(m.group())
        if 16 <= len(number) <= 19 and luhn(number):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                found.append((3, *m.span()))
    return found


def plausible(kind: int, text: str) -> bool:
    """What any span of a kind must have; a tagged span without it is dropped."""
    digits = len(_digits(text))
    if kind == 0:
        return text.count("@") == 1 and "." in text.split("@")[1].strip(".") and text[0] != "@"
    if kind == 1:
        parts = [p for p in re.split(r"[^0-9]+", text) if p]
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if not (text[0].isdigit() or text[0] in "+(") or not text[-1].isdigit():
        return False
    if kind == 2:
        return 13 <= digits <= 19 and luhn(_digits(text))
    return 7 <= digits <= 15 and re.fullmatch(r"[\x20()+./0-9-]+", text) is not None


def variant(kind: int, text: str, rng: random.Random) -> str:
    """The same kind of data with other digits, and in ways that the patterns do not cover."""
    if kind == 2:
        groups = rng.choice([None, " ", "-", "."])
        number = _digits(text)
        return text if groups is None else groups.join(number[n : n + 4] for n in range(0, len(number), 4))
    out = "".join(str(rng.randint(0, 9)) if c.isdigit() and kind == 3 else c for c in text)
    if kind == 3:
        plain = _digits(out)[-10:]
        if len(plain) == 10 and rng.random() < 0.6:
            a, b, c = plain[:3], plain[3:6], plain[6:]
            return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"])
    return out


def training_windows(text: str, key: int) -> Iterator[tuple[str, list[Span]]]:
    """Windows around spans, some with a variant in place of the span, and around other digits."""
    rng = random.Random(key)
    spans = base_spans(text)
    taken = [(s, e) for _, s, e in spans]
    others = [m.start() for m in ANCHOR.finditer(text) if not any(s <= m.start() < e for s, e in taken)]
    rng.shuffle(spans)
    for kind, start, end in spans[: TRAIN_WINDOWS - 2]:
        if end - start > TRAIN_WINDOW // 2:
            continue
        content = text[start:end] if rng.random() < 0.5 else variant(kind, text[start:end], rng)
        lead = rng.randint(0, TRAIN_WINDOW - len(content))
        begin = max(0, start - lead)
        # Other spans nearby would be cut or unlabelled; the surroundings end before them.
        begin = max([begin, *(e for _, e in taken if e <= start)])
        stop = min([end + TRAIN_WINDOW, *(s for s, _ in taken if s >= end)])
        window = (text[begin:start] + content + text[end:stop])[:TRAIN_WINDOW]
        at = start - begin
        if at + len(content) <= TRAIN_WINDOW:
            yield window, [(kind, at, at + len(content))]
    for at in rng.sample(others, min(2, len(others))):
        begin = max([0, at - rng.randint(0, TRAIN_WINDOW - 1), *(e for _, e in taken if e <= at)])
        stop = min([begin + TRAIN_WINDOW, *(s for s, _ in taken if s > at)])
        yield text[begin:stop], []


def labels_of(spans: list[Span], size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for kind, start, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def learn(windows: list[tuple[str, list[Span]]]) -> dict | None:
    """Weights of the tagger; None where there is no labelled span to learn from."""
    if not any(spans for _, spans in windows):
        return None
    codes = np.stack([tagger.encode(text, TRAIN_WINDOW) for text, _ in windows])
    gold = np.stack([labels_of(spans, TRAIN_WINDOW) for _, spans in windows])
    return tagger.train(codes, gold)


def _starts(size: int) -> range:
    return range(0, max(1, size - OVERLAP), WINDOW - OVERLAP)


def label_texts(weights: dict, texts: list[str], every: bool = False) -> list[dict[int, int]]:
    """Labels other than outside, by place in each text. ``every`` decodes all windows."""
    spots, windows = [], []
    for n, text in enumerate(texts):
        for start in _starts(len(text)):
            if every or ANCHOR.search(text, start, start + WINDOW):
                spots.append((n, start))
                windows.append(text[start : start + WINDOW])
    out: list[dict[int, int]] = [{} for _ in texts]
    if not windows:
        return out
    decoded = tagger.decode(weights, windows, WINDOW)
    for (n, start), labels in zip(spots, decoded):
        low = 0 if start == 0 else OVERLAP // 2
        high = len(texts[n]) - start if start + WINDOW >= len(texts[n]) else WINDOW - OVERLAP // 2
        for at in np.flatnonzero(labels[low:high]).tolist():
            out[n][start + low + at] = int(labels[low + at])
    return out


def join_spans(text: str, labels: dict[int, int]) -> list[Span]:
    """Spans over a whole text from the labels of its characters."""
    spans: list[list[int]] = []
    for at in sorted(labels):
        kind, first = (labels[at] - 1) // 2, labels[at] % 2
        if spans and not first and spans[-1][0] == kind and spans[-1][2] == at:
            spans[-1][2] = at + 1
        else:
            spans.append([kind, at, at + 1])
    return [(k, s, e) for k, s, e in spans if plausible(k, text[s:e])]


def all_spans(texts: list[str], weights: dict | None, every: bool = False) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, base and added spans) of each text; added ones overlap no base span."""
    labels = label_texts(weights, texts, every) if weights else [{} for _ in texts]
    out = []
    for text, marks in zip(texts, labels):
        base = base_spans(text)
        added = [
            span
            for span in join_spans(text, marks)
            if not any(s < span[2] and span[1] < e for _, s, e in base)
        ]
        out.append((base, sorted(base + added)))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """The tagger, from at most ``TRAIN_DOCS`` documents.

    Each kind of span has a like share of them, documents that seem to hold one, and so have
    documents with a digit or an ``@`` but no span. So the tagger has spans to learn from
    wherever there are any, however rare they are.
    """
    key = F.xxhash64(id_col, text_col)
    kinds = [F.col(text_col).rlike(pattern).alias(f"__k{n}") for n, pattern in enumerate(LIKELY)]
    known = docs.where(F.col(text_col).rlike("[0-9@]")).select(key.alias("__key"), *kinds).distinct()
    known = materialize(known, "training_documents").frame
    share = TRAIN_DOCS // (len(kinds) + 1)
    names = [f"__k{n}" for n in range(len(kinds))]
    shares = [*names, " AND ".join(f"NOT {name}" for name in names)]
    chosen = reduce(
        DataFrame.unionByName,
        [known.where(part).select("__key").orderBy("__key").limit(share) for part in shares],
    ).distinct()
    rows = docs.select(key.alias("__key"), text_col).join(F.broadcast(chosen), "__key").distinct()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("key", pa.int64()), ("window", pa.string()), ("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for number, text in zip(*column_lists(batch)):
                for window, spans in training_windows(text, number):
                    marks = [{"kind": k, "start": s, "end": e} for k, s, e in spans]
                    for column, value in zip(out, (number, window, marks)):
                        column.append(value)
            yield to_batch(schema, out)

    types = "key long, window string, spans array<struct<kind:int,start:int,end:int>>"
    got = rows.mapInArrow(run, types).collect()
    got.sort(key=lambda r: (r["key"], r["window"], [tuple(s) for s in r["spans"]]))
    return learn([(r["window"], [tuple(s) for s in r["spans"]]) for r in got])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) per row of ``docs``: arrays of (kind, start, end) in code points.

    A NULL or empty text has none.
    """
    weights = fit(docs, id_col, text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("id", pa.int64()), ("base", span), ("spans", span)])

    def named(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = column_lists(batch)
            found = all_spans([t or "" for t in texts], weights)
            yield to_batch(schema, [ids, [named(b) for b, _ in found], [named(s) for _, s in found]])

    kind = "array<struct<kind:string,start:long,end:long>>"
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(run, f"id long, base {kind}, spans {kind}").withColumnRenamed("id", id_col)


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of the base spans, a digest of them, and all spans as text."""

    def written(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return find_pii(docs).select(
        "doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans")
    )
