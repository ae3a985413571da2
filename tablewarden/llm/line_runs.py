"""Removal of repeated runs of lines with a suffix array over line ids.

The lines of all documents form one sequence of line ids with a break after each document.
Prefix doubling ranks its suffixes: by their first line, then by pairs of ranks one, two,
four lines apart. A rank is the place in the suffix array where the suffixes begin that agree
in all lines compared so far, so suffixes of equal rank are an interval whose longest common
prefix has at least that many lines. A suffix that is alone in its interval repeats nothing
and drops out; doubling ends when none is left.

``common_prefixes`` then narrows the length of each suffix's longest repeated prefix down from
the last depth at which it was not alone, by half steps with the ranks of the smaller depths.
These lengths are those of the maximal repeated runs.

What is deleted: of the suffixes that share ``min_lines`` lines the first stays, and the lines of
the others go. A copy that overlaps the first within its document stays too, so that the first
is whole. Every copy of a longer run is covered by copies of exactly ``min_lines``, so deletion
asks for no deeper ranks; neighbouring deletions merge into the maximal runs. A line that has
``SINGLE_WORDS`` words or ``SINGLE_CHARS`` characters is a run by itself; a shorter one recurs by
chance and goes only within a run of ``min_lines``.

DataFrame functions only. Pairs of ranks are counted before they move, and the places within
a rank are summed in two steps, so that a line that holds a third of all rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewarden.llm.common import bind, keyed, texts, true_id
from tablewarden.materialize import WrittenTable, materialize

BLANKS = " \t\n\x0b\x0c\r"
WORD_CHAR = r"[^\x20\x09-\x0D]"
BETWEEN = r"[\x20\x09-\x0D]+"
MIN_LINES = 2
# A line with either counts as a repeated run by itself; characters are for scripts without blanks.
SINGLE_WORDS = 8
SINGLE_CHARS = 50
# Parts in which the places of one rank, or of all lines, are summed.
PARTS = 1 << 12

SPOT = ["__id", "__hash", "__at"]


def _long(line: Column) -> Column:
    """Whether a trimmed line is a run by itself."""
    return (F.size(F.split(line, BETWEEN)) >= SINGLE_WORDS) | (F.length(line) >= SINGLE_CHARS)


def line_ids(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", singles: bool = True
) -> DataFrame:
    """(__id, __hash, __at, __line, __h1, __h2) per line with a word.

    ``__at`` counts these lines, ``__line`` all lines. Outer blanks do not count. A row that
    repeats id and text is one document. With ``singles`` there is also ``__single``, which
    marks the lines that are long enough to be a run.
    """

    def ids(text: Column) -> Column:
        lines = F.transform(
            F.split(text, "\n"),
            lambda x, i: F.struct(F.btrim(x, F.lit(BLANKS)).alias("t"), i.alias("i")),
        )
        return F.transform(
            F.filter(lines, lambda x: x["t"] != ""),
            lambda x: F.struct(
                x["i"].alias("line"),
                F.xxhash64(x["t"]).alias("h1"),
                F.xxhash64(F.lit(1), x["t"]).alias("h2"),
                *([_long(x["t"]).alias("single")] if singles else []),
            ),
        )

    rows = texts(docs, id_col, text_col).select("__id", "__hash", F.posexplode(ids(F.col("__text"))))
    return rows.select(
        "__id",
        "__hash",
        F.col("pos").alias("__at"),
        F.col("col.line").alias("__line"),
        F.col("col.h1").alias("__h1"),
        F.col("col.h2").alias("__h2"),
        *([F.col("col.single").alias("__single")] if singles else []),
    ).distinct()


def _places(classes: DataFrame, group: list[str], part: Column, order: list[str]) -> DataFrame:
    """``classes`` with ``__before``: the members of the group's smaller classes."""
    named = classes.withColumn("__part", part)
    sums = named.groupBy(*group, "__part").agg(F.sum("__n").alias("__sum"))
    until = (Window.unboundedPreceding, -1)
    coarse = Window.partitionBy(*group).orderBy("__part").rowsBetween(*until)
    fine = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(*until)
    sums = sums.select(*group, "__part", F.coalesce(F.sum("__sum").over(coarse), F.lit(0)).alias("__far"))
    near = F.coalesce(F.sum("__n").over(fine), F.lit(0))
    return named.withColumn("__near", near).join(sums, [*group, "__part"]).withColumn(
        "__before", F.col("__far") + F.col("__near")
    ).drop("__part", "__near", "__far")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """(spot, __rank) of the lines whose line id occurs again."""
    classes = lines.groupBy("__h1", "__h2").agg(F.count("*").alias("__n")).where("__n > 1")
    part = F.shiftright("__h1", 64 - (PARTS.bit_length() - 1))
    whole = _places(classes.withColumn("__all", F.lit(0)), ["__all"], part, ["__h1", "__h2"])
    ranks = materialize(whole.select("__h1", "__h2", F.col("__before").alias("__rank")), "ranks")
    return lines.join(ranks.frame, ["__h1", "__h2"]).select(*SPOT, "__rank")


def _deeper(suffixes: DataFrame, size: int, step: int) -> DataFrame:
    """Ranks by the pair of ranks ``step`` lines apart; suffixes alone in a pair drop out."""
    ahead = suffixes.select("__id", "__hash", (F.col("__at") - step).alias("__at"), F.col("__rank").alias("__next"))
    pairs = materialize(suffixes.join(ahead, SPOT), "pairs").frame
    classes = pairs.groupBy("__rank", "__next").agg(F.count("*").alias("__n")).where("__n > 1")
    part = F.floor(F.col("__next") * F.lit(PARTS) / F.lit(max(1, size)))
    placed = _places(classes, ["__rank"], part, ["__next"])
    ranks = materialize(
        placed.select("__rank", "__next", (F.col("__rank") + F.col("__before")).alias("__deeper")), "ranks"
    ).frame
    return pairs.join(ranks, ["__rank", "__next"]).select(*SPOT, F.col("__deeper").alias("__rank"))


def doubled(lines: DataFrame, until: int | None = None) -> list[WrittenTable]:
    """The suffixes that share 1, 2, 4, ... lines or more with another, as (spot, __rank): up to
    ``until`` lines, or as deep as any two agree."""
    levels = [materialize(_first_ranks(lines), "suffixes")]
    while levels[-1].rows and (until is None or 2 << (len(levels) - 1) <= until):
        known = levels[-1]
        levels.append(materialize(_deeper(known.frame, known.rows, 1 << (len(levels) - 1)), "suffixes"))
    return levels


def repeated_suffixes(levels: list[WrittenTable], min_lines: int) -> DataFrame:
    """(spot, __rank) of the suffixes that share ``min_lines`` lines or more with another."""
    power = min(min_lines.bit_length(), len(levels)) - 1
    known, rest = levels[power], min_lines - (1 << power)
    if not rest or not known.rows:
        return known.frame
    return materialize(_deeper(known.frame, known.rows, rest), "suffixes").frame


def _entering(level: DataFrame, deeper: DataFrame, depth: int) -> DataFrame:
    """The suffixes of ``level`` whose longest repeated prefix has ``depth`` to twice as many
    lines, and one suffix as witness of each deeper class that such a suffix agrees with."""
    below = deeper.withColumnRenamed("__rank", "__sub")
    split = materialize(level.join(below, SPOT, "left"), "split").frame
    open_ = split.where("__sub IS NULL")
    # Suffixes of the deeper level agree with their own class further, and need no witness here.
    classes = split.where("__sub IS NOT NULL").groupBy("__rank", "__sub").agg(F.min(F.struct(*SPOT)).alias("__spot"))
    seen = classes.join(open_.select("__rank").distinct(), "__rank", "left_semi").select("__spot.*", "__rank")
    # A class goes by the least of its spots, which no other class of its depth has.
    both = materialize(
        open_.select(*SPOT, "__rank", F.lit(True).alias("__real")).unionByName(
            seen.withColumn("__real", F.lit(False))
        ),
        "entering",
    ).frame
    names = both.groupBy("__rank").agg(F.min(F.struct(*SPOT)).alias("__class"))
    return both.join(names, "__rank").select(*SPOT, F.lit(depth).alias("__depth"), "__class", "__real")


def _stretched(state: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """``state`` with the classes split by what follows: suffixes that still agree with another
    ``step`` lines further go on there, the others stay with a witness of each class that left."""
    key = ["__depth", "__class"]
    ahead = level.select("__id", "__hash", F.col("__at").alias("__to"), F.col("__rank").alias("__next"))
    to = state.withColumn("__to", F.col("__at") + F.col("__depth"))
    tried = materialize(to.join(ahead, ["__id", "__hash", "__to"], "left").drop("__to"), "tried").frame
    subs = materialize(
        tried.groupBy(*key, "__next").agg(
            F.min(F.struct(*SPOT)).alias("__sub"),
            F.max("__real").alias("__any"),
            (F.col("__next").isNotNull() & (F.count("*") > 1)).alias("__agree"),
        ),
        "subclasses",
    ).frame
    left = subs.where(~F.col("__agree") & F.col("__any")).select(*key).distinct()
    agree = subs.where("__agree")
    moved = tried.join(agree.where("__any").drop("__any"), [*key, "__next"]).select(
        *SPOT, (F.col("__depth") + step).alias("__depth"), F.col("__sub").alias("__class"), "__real"
    )
    alone = tried.join(agree.select(*key, "__next"), [*key, "__next"], "left_anti")
    staying = alone.join(left, key, "left_semi").select(*SPOT, *key, "__real")
    witnesses = agree.join(left, key, "left_semi").select("__sub.*", *key, F.lit(False).alias("__real"))
    return moved.unionByName(staying).unionByName(witnesses)


def common_prefixes(levels: list[WrittenTable]) -> DataFrame:
    """(spot, __depth): for each suffix whose first line occurs again, the number of lines of its
    longest prefix that also begins at another place. ``levels`` go as deep as any two agree."""
    state = None
    for power in range(len(levels) - 2, 0, -1):
        entering = _entering(levels[power].frame, levels[power + 1].frame, 1 << power)
        state = entering if state is None else state.unionByName(entering)
        state = materialize(_stretched(state, levels[power - 1].frame, 1 << (power - 1)), "stretched").frame
    first = levels[0].frame.select(*SPOT)
    if state is None:
        return first.withColumn("__depth", F.lit(1))
    known = state.where("__real").select(*SPOT, "__depth")
    return first.join(known, SPOT, "left").withColumn("__depth", F.coalesce("__depth", F.lit(1)))


def _later_singles(lines: DataFrame) -> DataFrame:
    """(spot) of the later copies of lines that are long enough to be a run."""
    long = lines.where("__single")
    firsts = long.groupBy("__h1", "__h2").agg(F.min(F.struct(*SPOT)).alias("__first"), F.count("*").alias("__n"))
    repeated = materialize(firsts.where("__n > 1").drop("__n"), "single_firsts").frame
    return long.join(repeated, ["__h1", "__h2"]).where(F.struct(*SPOT) != F.col("__first")).select(*SPOT)


def repeated_lines(
    docs: DataFrame,
    min_lines: int = MIN_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    singles: bool = True,
) -> DataFrame:
    """(__id, __hash, __gone): per document with any, the numbers of its deleted lines and
    of the maximal runs they form."""
    lines = materialize(line_ids(docs, id_col, text_col, singles), "lines").frame
    return _gone(lines, doubled(lines, min_lines), min_lines, singles)


def _gone(lines: DataFrame, levels: list[WrittenTable], min_lines: int, singles: bool) -> DataFrame:
    suffixes = repeated_suffixes(levels, min_lines)
    firsts = materialize(
        suffixes.groupBy("__rank").agg(F.min(F.struct(*SPOT)).alias("__first")), "firsts"
    ).frame
    first = F.col("__first")
    # A copy that begins within the first one, itself included, would cut into it.
    apart = (
        (F.col("__id") != first["__id"])
        | (F.col("__hash") != first["__hash"])
        | (F.col("__at") >= first["__at"] + min_lines)
    )
    later = suffixes.join(firsts, "__rank").where(apart)
    spots = later.select(
        "__id", "__hash", F.explode(F.sequence("__at", F.col("__at") + (min_lines - 1))).alias("__at")
    )
    if singles:
        spots = spots.unionByName(_later_singles(lines))
    gone = spots.distinct().join(lines, SPOT).select("__id", "__hash", "__at", "__line")
    return gone.groupBy("__id", "__hash").agg(
        F.sort_array(F.collect_list(F.struct("__at", "__line"))).alias("__gone")
    )


def _runs(gone: Column) -> Column:
    """Number of maximal runs in the sorted deleted lines."""

    def begins(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(gone, i - 1)["__at"] + 1 != x["__at"], F.lit(True))

    return F.size(F.filter(gone, begins)).cast("long")


def _kept(text: Column, gone: Column) -> Column:
    """``text`` without the deleted lines."""

    def without(lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        left = F.array_except(numbers, F.transform(gone, lambda x: x["__line"]))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return bind(F.split(text, "\n"), without)


def dedup_lines(
    docs: DataFrame,
    min_lines: int = MIN_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    singles: bool = True,
) -> DataFrame:
    """Per row of ``docs`` its columns as ``__row``, ``__gone`` (NULL where nothing goes) and
    ``__kept``, the text left.

    Documents rank by id, NULL last, then by a hash of their text. A row without lines to
    delete keeps its text as it is, NULL included; one whose lines all go has an empty text.
    """
    gone = materialize(repeated_lines(docs, min_lines, id_col, text_col, singles), "gone").frame
    return _with_kept(docs, gone, id_col, text_col)


def _with_kept(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    # One plan at every size: the texts are dealt by document, however few of them change.
    joined = keyed(docs, id_col, text_col).join(gone.hint("merge"), ["__id", "__hash"], "left")
    text = F.col("__row").getField(text_col)
    kept = bind(F.col("__gone"), lambda g: _kept(text, g))
    return joined.withColumn("__kept", F.when(F.col("__gone").isNull(), text).otherwise(kept))


def line_report(docs: DataFrame, min_lines: int = MIN_LINES, singles: bool = True) -> DataFrame:
    """Per document: lines with a word, deleted lines, their runs, the lines of the longest run
    in it that also begins at another place of any document, SHA-256 of the text left.

    NULL and empty texts have no lines; rows that repeat id and text have one result each and are
    no copies of each other.
    """
    slim = docs.select("doc_id", "text")
    found = materialize(line_ids(slim, singles=singles), "lines").frame
    levels = doubled(found)
    gone = _gone(found, levels, min_lines, singles)
    longest = common_prefixes(levels).groupBy("__id", "__hash").agg(F.max("__depth").alias("__longest"))
    facts = materialize(longest.join(gone, ["__id", "__hash"], "left"), "facts").frame
    lines = F.filter(
        F.split(F.coalesce("__row.text", F.lit("")), "\n"), lambda x: x.rlike(WORD_CHAR)
    )
    return _with_kept(slim, facts, "doc_id", "text").select(
        "__row.doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(bind(F.col("__gone"), _runs), F.lit(0)).cast("long").alias("n_runs"),
        F.coalesce("__longest", F.lit(0)).cast("long").alias("longest_run"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"),
    )


def keep_lines(docs: DataFrame, min_lines: int = MIN_LINES, singles: bool = True) -> DataFrame:
    """``docs`` with the text left, and ``n_chars`` counted again where it is a column.

    NULL and empty texts stay as they are; rows that repeat id and text are cut alike.
    """
    cleaned = dedup_lines(docs, min_lines, singles=singles)
    fresh = {"text": F.col("__kept"), "n_chars": F.length("__kept").cast("long")}
    return cleaned.select(
        *[
            (F.when(F.col("__gone").isNull(), own).otherwise(fresh[c]) if c in fresh else own).alias(c)
            for c, own in ((c, F.col("__row").getField(c)) for c in docs.columns)
        ]
    )


ORACLE = r"""
WITH RECURSIVE raw AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, i AS line, parts[i] AS raw_line,
    trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM raw, unnest(generate_series(1, len(parts))) AS u(i)
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos,
    dense_rank() OVER (ORDER BY t) AS line_id FROM lines WHERE t <> ''
), windows AS (
  SELECT doc_id, pos, 2 AS n, t, lead(t) OVER (PARTITION BY doc_id ORDER BY line) AS t2 FROM worded
  UNION ALL SELECT doc_id, pos, 1, t, '' FROM worded
  WHERE length(t) >= 50 OR len(string_split_regex(t, '[\x20\x09-\x0D]+')) >= 8
), ranked AS (
  SELECT doc_id, pos, n, first_value(doc_id) OVER same AS first_doc, first_value(pos) OVER same AS first_pos
  FROM windows WHERE t2 IS NOT NULL WINDOW same AS (PARTITION BY n, t, t2 ORDER BY doc_id, pos)
), gone AS (
  SELECT DISTINCT doc_id, pos + d AS pos FROM ranked, (VALUES (0), (1)) AS v(d)
  WHERE d < n AND (doc_id <> first_doc OR pos >= first_pos + n)
), runs AS (
  SELECT doc_id, count(*) AS n_removed,
    sum(CASE WHEN before IS NULL OR before + 1 <> pos THEN 1 ELSE 0 END) AS n_runs
  FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone)
  GROUP BY doc_id
), deep AS (
  SELECT 1 AS depth, doc_id, pos, k FROM (
    SELECT doc_id, pos, line_id AS k, count(*) OVER (PARTITION BY line_id) AS copies FROM worded)
  WHERE copies > 1
  UNION ALL
  SELECT depth, doc_id, pos, k FROM (
    SELECT d.depth + 1 AS depth, d.doc_id, d.pos, dense_rank() OVER (ORDER BY d.k, w.line_id) AS k,
      count(*) OVER (PARTITION BY d.k, w.line_id) AS copies
    FROM deep d JOIN worded w ON w.doc_id = d.doc_id AND w.pos = d.pos + d.depth)
  WHERE copies > 1
), longest AS (
  SELECT doc_id, max(depth) AS longest_run FROM deep GROUP BY doc_id
), left_over AS (
  SELECT l.doc_id, string_agg(l.raw_line, chr(10) ORDER BY l.line) AS kept
  FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.line = w.line
  LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
  WHERE g.pos IS NULL GROUP BY l.doc_id
), counts AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id)
SELECT r.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(u.n_removed, 0) AS n_removed,
  CAST(coalesce(u.n_runs, 0) AS BIGINT) AS n_runs, CAST(coalesce(m.longest_run, 0) AS BIGINT) AS longest_run,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM raw r LEFT JOIN counts c ON r.doc_id = c.doc_id LEFT JOIN runs u ON r.doc_id = u.doc_id
LEFT JOIN longest m ON r.doc_id = m.doc_id LEFT JOIN left_over k ON r.doc_id = k.doc_id
"""
