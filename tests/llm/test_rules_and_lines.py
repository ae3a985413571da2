"""Quality rules and line runs against brute force and SQL."""

import collections
import re

import pytest

from oracle import compare
from tablewarden.llm import line_runs, quality_rules
from tablewarden.llm.queries import ORACLES, QUERIES
from texts_fixture import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_matches_sql(spark, name, folder):
    compare(spark, QUERIES[name], ORACLES[name], folder)


def counts(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in quality_rules.SYMBOLS),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_on_odd_rows(spark):
    texts = ["a b a b a b a", "a a a", "x y", "# $ a|b <>", "\x0b a\x0cb \r\n a\x0cb ", "é é é é", "  a", "1 2 3 1 2 3"]
    rows = [(200 + n, t, "en", "a", 1) for n, t in enumerate(texts)]
    docs = frame(spark).unionByName(frame(spark, rows))
    got = collections.Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in quality_rules.rules_report(docs).collect()
    )
    assert got == collections.Counter((r.doc_id, *counts(r.text)) for r in docs.collect())


def test_odd_source_is_rejected_and_clean_ones_stay(spark):
    rows = [(n, prose(n, 80), "en", f"s{n % 3}", 1) for n in range(900)]
    rows += [(5000, " | ".join(prose(7, 80).split()), "en", "s0", 1), (5001, prose(8, 90), "xx", "new", 1)]
    kept = {r.doc_id: r.kept for r in quality_rules.rules_report(frame(spark, rows)).collect()}
    assert not kept.pop(5000)
    assert all(kept.values())


def test_each_fence_rejects_alone(spark):
    plain = prose(500, 100).replace("\n", " ").split()
    odd = {
        "word_length": " ".join(w + "abcdefgh" for w in plain),
        "symbols": " ".join(w + "#" * (i % 10 == 0) for i, w in enumerate(plain)),
        "dup_lines": "\n".join(line + "\nk1" for line in prose(501, 72).split("\n")),
        "repeats": " ".join(plain[:53] + plain[3:26] + plain[53:77]),
    }
    rows = [(n, prose(n, 60), "en", "a", 1) for n in range(250)]
    rows += [(1000 + n, text, "en", "a", 1) for n, text in enumerate(odd.values())]
    measured = quality_rules.measure(frame(spark, rows))
    (fence,) = quality_rules.thresholds(measured).where("__level = 0").collect()
    ratios = quality_rules._ratios()
    found = measured.where("doc_id >= 1000").select("doc_id", *[r.alias(n) for n, r in ratios.items()]).orderBy("doc_id")
    for name, row in zip(odd, found.collect()):
        outside = {n for n in ratios if not fence[f"__low_{n}"] <= row[n] <= fence[f"__high_{n}"]}
        assert outside == {name}
    got = {r.doc_id: r for r in quality_rules.rules_report(frame(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == {1000, 1001, 1002, 1003}


def test_each_source_has_its_own_sketch(spark):
    """What is common in one source is odd in another of the same language."""
    signed = lambda n: prose(n, 60).replace(" ", " #")
    rows = [(n, prose(n, 60), "en", "web", 1) for n in range(220)]
    rows += [(300 + n, signed(n), "en", "code", 1) for n in range(220)]
    rows += [(1000, signed(900), "en", "web", 1), (1001, signed(901), "en", "code", 1)]
    kept = {r.doc_id: r.kept for r in quality_rules.rules_report(frame(spark, rows)).collect()}
    assert [d for d, k in kept.items() if not k] == [1000]


def test_no_thresholds_without_passing_documents(spark):
    got = quality_rules.rules_report(frame(spark, [(1, "too short", "en", "a", 1)])).collect()
    assert [(r.base_failed, r.kept) for r in got] == [(True, False)]


def worded(text):
    lines = [(n, x.strip(line_runs.BLANKS)) for n, x in enumerate((text or "").split("\n"))]
    return [(n, x) for n, x in lines if x]


def brute_lines(rows, size, singles=False):
    """Deleted line numbers per document; documents in rank order."""
    first, gone = {}, {}
    for key, text in rows:
        lines = worded(text)
        for length in (size, 1) if singles else (size,):
            for at in range(len(lines) - length + 1):
                run = tuple(x for _, x in lines[at : at + length])
                if length != size and len(run[0].split()) < 8 and len(run[0]) < 50:
                    continue
                doc, place = first.setdefault(run, (key, at))
                if doc != key or at >= place + length:
                    gone.setdefault(key, set()).update(n for n, _ in lines[at : at + length])
    return gone


def brute_longest(rows):
    """Lines of the longest run per document that begins at two places or more."""
    found = {}
    for key, text in rows:
        found[key] = 0
        lines = [x for _, x in worded(text)]
        others = [[x for _, x in worded(t)] for k, t in rows if k != key]
        for a in range(len(lines)):
            for other in [lines, *others]:
                for b in range(len(other)):
                    n = 0
                    while a + n < len(lines) and b + n < len(other) and lines[a + n] == other[b + n]:
                        n += 1
                    if other is not lines or a != b:
                        found[key] = max(found[key], n)
    return found


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_runs_of_any_length(spark, size):
    import random

    rng = random.Random(size)
    rows = [
        (n, "\n".join(rng.choice(["a", "b", " b ", "", "c"]) for _ in range(rng.randint(0, 30))), "en", "a", 1)
        for n in range(40)
    ]
    got = {
        (r["__id"]): {g["__line"] for g in r["__gone"]}
        for r in line_runs.repeated_lines(frame(spark, rows), size, singles=False).collect()
    }
    assert got == brute_lines([(n, t) for n, t, *_ in rows], size)


@pytest.mark.parametrize("letters", ["ab", "abcdefghij"])
def test_longest_runs_and_deleted_lines_against_brute_force(spark, letters):
    """Runs of all lengths, copied from document to document with other borders."""
    import random

    rng = random.Random(len(letters))
    long = ["x" * 50, "one two three four five six seven eight", "\u4e2d" * 50]
    texts = []
    for n in range(30):
        lines = [rng.choice(letters) if rng.random() < 0.9 else rng.choice(long) for _ in range(rng.randint(0, 12))]
        if texts and rng.random() < 0.7:
            donor = rng.choice(texts)
            at, size = rng.randint(0, len(donor)), rng.choice([1, 2, 3, 5, 7, 11])
            lines[len(lines) // 2 : len(lines) // 2] = donor[at : at + size]
        texts.append(lines)
    rows = [(n, "\n".join(t), "en", "a", 1) for n, t in enumerate(texts)]
    plain = [(n, t) for n, t, *_ in rows]
    report = {r.doc_id: r for r in line_runs.line_report(frame(spark, rows)).collect()}
    assert {n: r.longest_run for n, r in report.items()} == brute_longest(plain)
    gone = brute_lines(plain, 2, singles=True)
    assert {n: r.n_removed for n, r in report.items()} == {n: len(gone.get(n, ())) for n, _ in plain}


def test_lengths_of_copied_runs(spark):
    sizes = [1, 2, 3, 7, 8, 9, 100]
    rows, want = [(999, "alone", "en", "a", 1)], {999: (0, 0, 0)}
    for size in sizes:
        run = "\n".join(f"line {n} of the shared run of {size} lines here" for n in range(size))
        rows += [(10 * size + n, f"start {size} {n}\n{run}\nend {size} {n}", "en", "a", 1) for n in range(3)]
        want |= {10 * size + n: (size, size if n else 0, 1 if n else 0) for n in range(3)}
    got = {r.doc_id: (r.longest_run, r.n_removed, r.n_runs) for r in line_runs.line_report(frame(spark, rows)).collect()}
    assert got == want


def test_the_first_run_stays_whole(spark):
    rows = [(1, "\n".join(["yes"] * 5), "en", "a", 1), (2, "no\nyes\nyes", "en", "a", 1), (3, "a\nb\na\nb\na\nb", "en", "a", 1)]
    got = {r.doc_id: r.text for r in line_runs.keep_lines(frame(spark, rows)).collect()}
    assert got == {1: "yes\nyes", 2: "no", 3: "a\nb"}


def test_hot_line_and_odd_rows(spark, skew_settings):
    shared = "the same first line\nthe same second line\n"
    rows = [(n, shared + prose(n, 24) + ("\n" + shared if n % 2 else ""), "en", "a", 1) for n in range(300)]
    out = line_runs.keep_lines(frame(spark, rows)).collect()
    assert sum("same second" in r.text for r in out) == 1
    assert all(r.n_chars == len(r.text) for r in out if r.doc_id)
    odd = line_runs.keep_lines(frame(spark))
    kept = collections.Counter((r.doc_id, r.text is None) for r in odd.collect())
    assert kept == collections.Counter((r.doc_id, r.text is None) for r in frame(spark).collect())


def test_long_single_lines_go(spark):
    nine, long = "a b c d e f g h i", "x" * 50
    texts = [f"one\n{nine}\ntwo\n{long}", f"three\n {nine} \nfour", f"{long}\nfive\none", nine, "one\nfive six"]
    rows = [(n, t, "en", "a", 1) for n, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in line_runs.keep_lines(frame(spark, rows)).collect()}
    assert got == {0: texts[0], 1: "three\nfour", 2: "five\none", 3: "", 4: "one\nfive six"}
