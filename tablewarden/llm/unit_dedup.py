"""Removal of repeated lines or paragraphs by their hash.

A text is cut into units, lines or paragraphs. Each unit that is not blank is normalised and
hashed, equal hashes are grouped over all documents, the first occurrence by document rank and
place stays and the others are cut out. What is left keeps its places in the original text.

With ``unit="sentence"`` every line is a unit as well, and within a line so are runs of its
sentences, which finds a passage pasted into the middle of a line. A sentence of few words
recurs by chance, so these are the shortest runs with ``min_words`` words that begin or that end
at each sentence of the line. They overlap, and together they cover every copied stretch of
whole sentences with that many words, whatever stands before and behind it. A copy that overlaps
the first occurrence of the same unit stays, so the first is whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import column_lists, id_rank, text_hash, texts, to_batch, true_id
from tablewarden.materialize import materialize

# What lies between two units.
BREAKS = {
    "paragraph": re.compile(r"\n[\x20\x09-\x0D]*\n\s*"),
    "line": re.compile(r"\n+"),
    "sentence": re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|\n+"),
}
WORD = re.compile(r"\w+")
MIN_WORDS = 8


def _cut(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the units that are not blank."""
    start = 0
    for gap in [*((m.start(), m.end()) for m in BREAKS[unit].finditer(text)), (len(text), len(text))]:
        if text[start : gap[0]].strip():
            yield start, gap[0]
        start = gap[1]


def _plain(text: str) -> str:
    """What two equal units have in common: case and spacing do not count, signs do."""
    return " ".join(text.lower().split())


def _sentence_runs(ends: list[tuple[int, int]], min_words: int) -> set[tuple[int, int]]:
    """(first, last) of the shortest runs with ``min_words`` words that begin or end at each
    sentence; ``ends`` are the places of each sentence's first word and behind its last."""
    runs = set()
    last = 0
    for first in range(len(ends)):
        last = max(first, last)
        while last < len(ends) and ends[last][1] - ends[first][0] < min_words:
            last += 1
        if last == len(ends):
            break
        runs.add((first, last))
    first = 0
    for last in range(len(ends)):
        while first < last and ends[last][1] - ends[first + 1][0] >= min_words:
            first += 1
        if ends[last][1] - ends[first][0] >= min_words:
            runs.add((first, last))
    return runs


def units(text: str | None, unit: str = "sentence", min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the units in order: every line or paragraph that is not blank,
    and for sentences also the runs within a line of ``min_words`` words or more.

    Case and spacing do not count. A NULL or empty text has no units.
    """
    text = text or ""
    found = []
    for a, b in _cut(text, "paragraph" if unit == "paragraph" else "line"):
        whole = _plain(text[a:b])
        found.append((a, b, whole))
        if unit != "sentence":
            continue
        spots = [(a + i, a + j) for i, j in _cut(text[a:b], "sentence")]
        plain = [_plain(text[i:j]) for i, j in spots]
        ends, n = [], 0
        for i, j in spots:
            n += len(WORD.findall(text[i:j]))
            ends.append((ends[-1][1] if ends else 0, n))
        for i, j in _sentence_runs(ends, min_words):
            # A run that begins or ends with signs alone is one with more than it needs.
            if ends[i][0] < ends[i][1] and ends[j][0] < ends[j][1] and (run := " ".join(plain[i : j + 1])) != whole:
                found.append((spots[i][0], spots[j][1], run))
    return sorted((a, b, xxhash.xxh3_128_digest(key.encode())) for a, b, key in found)


def merged(spans: list[dict] | None) -> list[dict]:
    """The sorted spans with those that overlap made one."""
    out: list[dict] = []
    for span in spans or []:
        if out and span["__start"] < out[-1]["__end"]:
            out[-1]["__end"] = max(out[-1]["__end"], span["__end"])
        else:
            out.append({"__start": span["__start"], "__end": span["__end"]})
    return out


def without(text: str | None, spans: list[dict] | None) -> str | None:
    """``text`` without the sorted, disjoint spans; NULL stays NULL."""
    if not spans or text is None:
        return text
    ends = [0] + [s["__end"] for s in spans]
    starts = [s["__start"] for s in spans] + [len(text)]
    return "".join(text[a:b] for a, b in zip(ends, starts))


def repeated_units(
    docs: DataFrame,
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(__id, __hash, __spans): the later occurrences, which may overlap each other but not the
    first of their kind, in each document that has any."""
    schema = pa.schema(
        [("__id", pa.int64()), ("__hash", pa.int64()), ("__start", pa.int32()), ("__end", pa.int32()),
         ("__digest", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc, mark, text in zip(*column_lists(batch)):
                for start, end, digest in units(text, unit, min_words):
                    for column, value in zip(out, (doc, mark, start, end, digest)):
                        column.append(value)
            yield to_batch(schema, out)

    names = "__id long, __hash long, __start int, __end int, __digest binary"
    found = materialize(texts(docs, id_col, text_col).mapInArrow(run, names), "units").frame
    spot = F.struct("__id", "__hash", "__start", "__end")
    firsts = found.groupBy("__digest").agg(F.min(spot).alias("__first"), F.count("*").alias("__n"))
    repeated = materialize(firsts.where("__n > 1").drop("__n"), "repeated").frame
    first = F.col("__first")
    same_text = (F.col("__id") == first["__id"]) & (F.col("__hash") == first["__hash"])
    later = found.join(repeated, "__digest").where(~(same_text & (F.col("__start") < first["__end"])))
    return later.groupBy("__id", "__hash").agg(
        F.sort_array(F.collect_set(F.struct("__start", "__end"))).alias("__spans")
    )


def dedup_units(
    docs: DataFrame,
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, removed, removed_chars, kept) per row: the text left, the spans cut out of
    the original text in code points, and the spans that stay.

    Documents rank by id, NULL last, then by a hash of their text; rows that repeat both are
    one document. A NULL text stays NULL.
    """
    spans = materialize(repeated_units(docs, unit, min_words, id_col, text_col), "spans").frame
    rows = docs.select(
        id_rank(id_col).alias("__id"), text_hash(text_col).alias("__hash"), F.col(text_col).alias("__text")
    )
    joined = rows.join(spans.hint("merge"), ["__id", "__hash"], "left").select("__id", "__text", "__spans")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [("__id", pa.int64()), ("text", pa.string()), ("removed", span), ("removed_chars", pa.int64()), ("kept", span)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc, text, spans in zip(*column_lists(batch)):
                gone = merged(spans)
                cuts = [(s["__start"], s["__end"]) for s in gone]
                ends = [0, *(e for _, e in cuts)]
                starts = [*(s for s, _ in cuts), len(text or "")]
                row = (
                    doc,
                    without(text, gone),
                    [{"start": s, "end": e} for s, e in cuts],
                    sum(e - s for s, e in cuts),
                    [{"start": s, "end": e} for s, e in zip(ends, starts) if e > s],
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield to_batch(schema, out)

    place = "array<struct<start:int,end:int>>"
    cleaned = joined.mapInArrow(
        run, f"__id long, text string, removed {place}, removed_chars long, kept {place}"
    )
    return cleaned.withColumn(id_col, true_id()).select(id_col, "text", "removed", "removed_chars", "kept")


def unit_report(docs: DataFrame) -> DataFrame:
    """Per row the text left, the number of spans and characters cut out, and where.

    The units are all lines, and the runs of sentences within them. A NULL text stays NULL, an
    empty one empty; rows that repeat id and text are one document and keep the same; of equal
    units the one of the least id stays, NULL last.
    """
    return dedup_units(docs.select("doc_id", "text")).select(
        "doc_id",
        "text",
        F.size("removed").cast("long").alias("n_removed"),
        F.col("removed_chars").alias("n_chars_removed"),
        F.array_join(
            F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ","
        ).alias("removed"),
    )
