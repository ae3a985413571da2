"""Quality rules with thresholds taken from the corpus, in DataFrame functions only.

Every document gets its base counts. Documents that pass the fixed base rules feed quantile
sketches per language and source, which tasks build in part and merge. A sketch gives the
quartiles of each ratio, and a fence around them takes the place of a fixed cutoff. Where a
source has too few documents, the sketch of the language counts, then that of all. The few
threshold rows are written and joined back, and a document outside a fence is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import bind, unkeyed
from tablewarden.materialize import materialize

BLANKS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Share of a sketch's rows by which the rank of a quartile may be off.
ACCURACY = 10_000
# Documents a sketch needs before it counts.
MIN_ROWS = 200
# Fences lie this many spreads outside the quartiles.
REACH = 5.0
# Ratio of a document, and the least spread it is given: sources of equal documents would
# otherwise reject the slightest difference. That of repeated words is small enough for the fence
# of a source that repeats nothing to lie below the base rule.
RATIOS = {"word_length": 0.5, "symbols": 0.01, "dup_lines": 0.08, "repeats": 0.08}
# Ratios of which low values are odd as well.
TWO_SIDED = {"word_length"}


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    Windows are compared by a 64-bit hash. Most texts repeat none, which a set of hashes
    shows; only the others are sorted.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(
            starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def placed(hashes: Column) -> Column:
        return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        def same(x: Column, i: Column, by: int) -> Column:
            return F.coalesce(x["h"] == F.get(s, i + by)["h"], F.lit(False))

        return F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1))

    def covered(at: Column) -> Column:
        """Each start covers three words, or fewer where the next one begins sooner."""
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.get(at, i + 1) - p))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, step: n + step)

    def count(hashes: Column) -> Column:
        starts = lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"]))
        covering = bind(placed(hashes), lambda s: bind(starts(s), covered))
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0).cast("long")).otherwise(covering)

    few = F.size(words) < 4
    return F.when(few, F.lit(0).cast("long")).otherwise(bind(words, lambda w: bind(windows(w), count)))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the struct ``__m`` of its base counts; a NULL text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR))
        return bind(
            _words(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                _repeat_words(w).alias("n_repeat_words"),
                bind(lines, F.size).cast("long").alias("n_lines"),
            ),
        )

    return docs.withColumn("__m", bind(text, counts))


def _base_failed() -> Column:
    m = F.col("__m")
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
    )


def _ratios() -> dict[str, Column]:
    m = F.col("__m")
    words = F.greatest(m["n_words"], F.lit(1))
    return {
        "word_length": m["word_chars"] / words,
        "symbols": m["n_symbols"] / words,
        "dup_lines": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
        "repeats": m["n_repeat_words"] / words,
    }


def thresholds(measured: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Fences per (lang, source), per lang and over all; NULL keys are groups of their own.

    One row per group: __level 0 to 2, the keys, and __low, __high per ratio.
    """
    ratios = _ratios()
    passing = measured.where(~_base_failed()).select(
        *[F.col(k).cast("string").alias(f"__k{i}") for i, k in enumerate(keys)],
        *[ratio.alias(name) for name, ratio in ratios.items()],
    )
    sketches = [
        F.percentile_approx(name, [0.25, 0.75], ACCURACY).alias(name) for name in ratios
    ]
    grouped = passing.rollup("__k0", "__k1").agg(
        F.grouping_id().alias("__g"), F.count("*").alias("__n"), *sketches
    )
    fences = []
    for name, least in RATIOS.items():
        spread = F.greatest(F.get(name, F.lit(1)) - F.get(name, F.lit(0)), F.lit(least))
        low = F.get(name, F.lit(0)) - REACH * spread
        fences += [
            (low if name in TWO_SIDED else F.lit(0.0)).alias(f"__low_{name}"),
            (F.get(name, F.lit(1)) + REACH * spread).alias(f"__high_{name}"),
        ]
    level = F.when(F.col("__g") == 0, 0).when(F.col("__g") == 1, 1).otherwise(2)
    return grouped.where((F.col("__n") >= MIN_ROWS) | (F.col("__g") == 3)).select(
        level.alias("__level"), "__k0", "__k1", *fences
    )


def judge(measured: DataFrame, fences: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``measured`` with ``__base_failed`` and ``__kept``.

    The fences of the finest group that has any count; where none of the documents passes
    the base rules there are none, and no document is left to judge.
    """
    names = [c for c in fences.columns if c.startswith(("__low", "__high"))]
    fence = F.struct(*names)
    own = [F.col(k).cast("string") for k in keys]
    # The joins are by equality alone, with a marker for NULL, so that a hot source can be split.
    known = lambda k: F.concat(F.lit("="), k)
    key = [F.coalesce(known(k), F.lit("")) for k in own]
    judged = measured.withColumns({"__j0": key[0], "__j1": key[1]})
    for level, by in ((0, ["__j0", "__j1"]), (1, ["__j0"]), (2, [])):
        at = fences.where(F.col("__level") == level).select(
            F.coalesce(known(F.col("__k0")), F.lit("")).alias("__j0"),
            F.coalesce(known(F.col("__k1")), F.lit("")).alias("__j1"),
            fence.alias(f"__f{level}"),
        )
        if by:
            judged = judged.join(at.select(*by, f"__f{level}"), by, "left")
        else:
            row = at.select(f"__f{level}").first()
            empty = F.lit(None).cast(at.schema[f"__f{level}"].dataType)
            values = F.struct(*[F.lit(row[0][n]).alias(n) for n in names]) if row else empty
            judged = judged.withColumn(f"__f{level}", values)
    judged = judged.withColumn("__f", F.coalesce("__f0", "__f1", "__f2"))
    inside = F.lit(True)
    for name, ratio in _ratios().items():
        inside &= ratio.between(F.col("__f")[f"__low_{name}"], F.col("__f")[f"__high_{name}"])
    failed = _base_failed()
    return judged.withColumns(
        {"__base_failed": failed, "__kept": ~failed & F.coalesce(inside, F.lit(True))}
    ).drop("__j0", "__j1", "__f0", "__f1", "__f2", "__f")


def quality_rules(
    docs: DataFrame, text_col: str = "text", keys: tuple[str, str] = ("lang", "source")
) -> DataFrame:
    """``docs`` with ``__m``, ``__base_failed`` and ``__kept``, one row for each row.

    Rows are measured once and written; the thresholds and the verdicts come from the
    written counts. An empty table gives an empty one.
    """
    measured = materialize(measure(docs, text_col), "measured").frame
    fences = materialize(thresholds(measured, keys), "fences").frame
    return judge(measured, fences, keys)


def rules_report(docs: DataFrame) -> DataFrame:
    """The counts and the verdict per row.

    A NULL or empty text counts as no words and fails the base rules; repeated rows are judged
    each, and alike; a NULL language or source is a group of its own.
    """
    slim = docs.select("doc_id", "text", "lang", "source")
    measured = measure(slim).drop("text")
    written = materialize(measured, "measured").frame
    fences = materialize(thresholds(written), "fences").frame
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(written, fences).select(
        "doc_id",
        *[F.col("__m")[n].alias(n) for n in names],
        F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns whatever they are called.

    NULL and empty texts fail the base rules; repeated rows are judged each, and alike.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    slim = docs.select(row.alias("__row"), "text", "lang", "source")
    measured = materialize(measure(slim).drop("text"), "measured").frame
    fences = materialize(thresholds(measured), "fences").frame
    return unkeyed(judge(measured, fences).where("__kept"), docs)


ORACLE = r"""
WITH raw AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM raw)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM raw, unnest(generate_series(1, len(w) - 2)) AS u(i)
), counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
  FROM counted, (VALUES (0), (1), (2)) AS v(d) WHERE n > 1 GROUP BY doc_id
), base AS (
  SELECT r.doc_id, r.lang, r.source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM raw r LEFT JOIN lines l ON r.doc_id = l.doc_id LEFT JOIN covered c ON r.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars / greatest(n_words, 1) AS r1, n_symbols / greatest(n_words, 1) AS r2,
    n_dup_lines / greatest(n_lines, 1) AS r3, n_repeat_words / greatest(n_words, 1) AS r4
  FROM base
), sketches AS (
  SELECT lang, source, grouping(lang, source) AS g, count(*) AS n,
    quantile_disc(r1, 0.25) AS l1, quantile_disc(r1, 0.75) AS h1,
    quantile_disc(r2, 0.25) AS l2, quantile_disc(r2, 0.75) AS h2,
    quantile_disc(r3, 0.25) AS l3, quantile_disc(r3, 0.75) AS h3,
    quantile_disc(r4, 0.25) AS l4, quantile_disc(r4, 0.75) AS h4
  FROM judged WHERE NOT base_failed GROUP BY ROLLUP (lang, source)
), fences AS (
  SELECT lang, source, g, l1 - 5.0 * greatest(h1 - l1, 0.5) AS low1, h1 + 5.0 * greatest(h1 - l1, 0.5) AS high1,
    h2 + 5.0 * greatest(h2 - l2, 0.01) AS high2, h3 + 5.0 * greatest(h3 - l3, 0.08) AS high3,
    h4 + 5.0 * greatest(h4 - l4, 0.08) AS high4
  FROM sketches WHERE n >= 200 OR g = 3
), chosen AS (
  SELECT j.*, f.*, row_number() OVER (PARTITION BY doc_id ORDER BY f.g) AS rank
  FROM judged j LEFT JOIN fences f ON (f.g = 3) OR (f.g = 1 AND f.lang IS NOT DISTINCT FROM j.lang)
    OR (f.g = 0 AND f.lang IS NOT DISTINCT FROM j.lang AND f.source IS NOT DISTINCT FROM j.source)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(r1 BETWEEN low1 AND high1 AND r2 <= high2 AND r3 <= high3 AND r4 <= high4, true) AS kept
FROM chosen WHERE rank = 1
"""
