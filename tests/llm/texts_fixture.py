"""Small tables with the odd rows that every operator must take."""

import random

WORDS = (
    "amber basin cedar delta ember fjord grove heron inlet juniper kelp lagoon meadow nectar "
    "orchid prairie quartz river summit thicket umber valley willow yarrow zephyr"
).split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of the operators' own making, and of their results.
CLASHES = ["__m", "fingerprint", "component_id", "piece", "length", "kept", "score", "spans", "col", "pos", "node"]


def prose(seed, words, line=12):
    rng = random.Random(seed)
    parts = []
    for at in range(0, words, line):
        parts.append(" ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(min(line, words - at))) + ".")
    return "\n".join(parts)


def odd_rows():
    """NULLs in any column, empty and long texts, ties, repeated rows, other scripts."""
    long_text = prose(99, 20_000)
    rows = [(n, prose(n, 60 + n), "en", "a", 1) for n in range(20)]
    rows += [
        (100, None, "en", "a", 1),
        (101, "", "en", None, 0),
        (102, " \n\t\n ", None, "b", 5),
        (103, long_text, "de", "b", len(long_text)),
        (104, prose(3, 63), "en", "a", 1),
        (3, prose(3, 63), "en", "a", 1),
        (3, prose(3, 63), "en", "a", 1),
        (3, prose(55, 80), "en", "a", None),
        (None, prose(4, 64), "fr", "b", 1),
        (None, None, None, None, None),
        (105, "Ünïcödé 日本語 text ñandú " * 30, "es", "b", 1),
        (106, "word", "en", "a", 4),
    ]
    return rows


def frame(spark, rows=None, clashes=False):
    docs = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    if clashes:
        for name in CLASHES:
            docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs
