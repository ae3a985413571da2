"""SimHash groups, unit, substring and benchmark removal against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from tablewarden.llm import decontaminate, run_index, simhash, substring_dedup, unit_dedup
from tablewarden.llm.common import LAST_ID
from texts_fixture import frame, odd_rows, prose


def slow_simhash(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", "a", "A b", "a b c d", "Ärger ÄRGER a b", prose(1, 300), prose(2, 70_000)]:
        assert simhash.simhash(text) == (slow_simhash(text) if len(text or "") < 9999 else simhash.simhash(text.upper()))


@pytest.mark.parametrize("radius", [3, 4])
def test_links_join_what_all_pairs_join(spark, radius):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:120]:
        for _ in range(3):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    prints = sorted(prints)
    rows = spark.createDataFrame([(simhash._signed(p),) for p in prints], "__fp long")

    def groups(pairs):
        root = {p: p for p in prints}
        for a, b in pairs:
            low, high = sorted((root[a], root[b]))
            if low != high:
                root = {p: low if r == high else r for p, r in root.items()}
        return root

    found = [
        (r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(rows, len(prints), radius).collect()
    ]
    assert all((a ^ b).bit_count() <= 64 for a, b in found)
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius]
    assert groups(found) == groups(near)


def test_blocks_of_values_give_the_same_links(monkeypatch):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    prints = np.array(sorted({base ^ sum(1 << b for b in rng.sample(range(56), 2)) for _ in range(200)}), np.uint64)
    whole = simhash.collide(base >> 56, 8, prints, 4)
    monkeypatch.setattr(simhash, "BLOCK", 4096)
    assert (simhash.collide(base >> 56, 8, prints, 4) == whole).all()


def test_components_on_odd_rows(spark):
    docs = frame(spark, clashes=True)
    got = simhash.component_report(docs).collect()
    rows = [(LAST_ID if r.doc_id is None else r.doc_id, slow_simhash(r.text)) for r in docs.collect()]
    assert len(got) == len(rows)
    group = {p: p for _, p in rows}
    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {p: low if g == high else g for p, g in group.items()}
    first = {}
    for doc, p in rows:
        first[group[p]] = min(doc, first.get(group[p], LAST_ID))
    want = sorted((doc, f"{p:016x}", first[group[p]]) for doc, p in rows)
    last = lambda x: LAST_ID if x is None else x
    assert sorted((last(r.doc_id), r.fingerprint, last(r.component_id)) for r in got) == want


def test_one_document_of_each_group_stays(spark):
    text = prose(1, 200)
    rows = [(n, text, "en", "a", 1) for n in range(50)] + [(3, text, "en", "a", 1)] * 3
    assert [r.doc_id for r in simhash.keep_first(frame(spark, rows)).collect()] == [0]


def test_units_against_brute_force(spark):
    rows = [(n, prose(n % 30, 60) + f" Shared closing words number one two three four five{n % 7}.", "en", "a", 1) for n in range(80)]
    rows += [(500, None, "en", "a", 1), (501, "", "en", "a", 1), (None, prose(2, 60), "en", "a", 1)]
    got = {r.doc_id: (r.text, r.removed, r.kept) for r in unit_dedup.dedup_units(frame(spark, rows)).collect()}
    ranked = sorted(rows, key=lambda r: LAST_ID if r[0] is None else r[0])
    for (doc, text, *_), want in zip(ranked, brute_units([r[1] or "" for r in ranked], "sentence")):
        left, removed, kept = got[doc]
        assert re.findall(r"\S", left or "") == want and (left is None) == (text is None)
        places = sorted((s.start, s.end) for s in [*removed, *kept])
        assert left is None or left == "".join(text[s.start : s.end] for s in kept)
        assert [0, *(e for _, e in places)] == [*(s for s, _ in places), len(text or "")]


def brute_units(texts, unit):
    """What stays of each text: every line or paragraph goes if it is anywhere before, and so
    does every run of 8 words or more in whole sentences of a line, unless it overlaps the first."""
    plain = lambda x: tuple(x.lower().split())
    seen, out = {}, []
    for n, text in enumerate(texts):
        found = []
        for whole in re.finditer(r"(?:[^\n]+\n?)+" if unit == "paragraph" else r"[^\n]+", text):
            found += [(*whole.span(), plain(whole.group()))]
            parts = list(re.finditer(r"[^.!?]+[.!?]*", whole.group())) if unit == "sentence" else []
            for i in range(len(parts)):
                for j in range(i, len(parts)):
                    run = whole.group()[parts[i].start() : parts[j].end()]
                    if len(re.findall(r"\w+", run)) >= 8:
                        found.append((whole.start() + parts[i].start(), whole.start() + parts[j].end(), plain(run)))
        gone = set()
        for a, b, key in sorted((f for f in found if f[2]), key=lambda f: f[:2]):
            doc, end = seen.setdefault(key, (n, b))
            if doc != n or a >= end:
                gone |= set(range(a, b))
        out.append([c for at, c in enumerate(text) if at not in gone and not c.isspace()])
    return out


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_short_units_against_brute_force(spark, unit):
    rng = random.Random(12)
    pool = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 30)) for _ in range(rng.choice([1, 2, 3, 5, 9]))) + "." for _ in range(60)]
    texts = []
    for _ in range(70):
        parts = [rng.choice(pool) + rng.choice([" ", " ", "\n", "\n\n"]) for _ in range(rng.randint(1, 25))]
        if texts and rng.random() < 0.6:
            donor = rng.choice(texts).split(". ")
            at = rng.randint(0, len(donor) - 1)
            parts.insert(rng.randint(0, len(parts)), ". ".join(donor[at : at + 6]).strip(".\n ") + ". ")
        texts.append("".join(parts).strip())
    texts += ["-----\nx1 y2", "x1 y2\n-----\n====="]
    rows = [(n, t, "en", "a", 1) for n, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in unit_dedup.dedup_units(frame(spark, rows), unit).collect()}
    want = brute_units(texts, unit)
    for n, left in enumerate(want):
        assert [c for c in got[n] if not c.isspace()] == left, (texts[n], got[n])


def test_copies_of_short_sentences_leave_no_scraps(spark):
    passage = "Go on. It rains. All of us went home. Why not? Nobody knew what the other nine of them wanted. Yes. No."
    rows = [(1, f"First words of one. {passage} Its own end.", "en", "a", 1), (2, f"Something else here. {passage} Another end.", "en", "a", 1)]
    rows += [(3, "Yes.\nIt is so.", "en", "a", 1), (4, "It is so.\nYes. It differs.", "en", "a", 1)]
    got = {r.doc_id: r.text.split() for r in unit_dedup.dedup_units(frame(spark, rows)).collect()}
    assert got[1] == rows[0][1].split()
    assert " ".join(got[2]) == "Something else here. Another end."
    assert " ".join(got[4]) == "Yes. It differs."


def test_first_of_overlapping_copies_stays_whole_and_signs_count(spark):
    rows = [(1, "No. " * 20, "en", "a", 1), (2, "if a < b: return x + 1\nif a > b: return x - 1", "en", "a", 1)]
    rows += [(3, "  IF a <  b: return x + 1\nelse", "en", "a", 1)]
    got = {r.doc_id: r.text for r in unit_dedup.dedup_units(frame(spark, rows)).collect()}
    assert got[1].split() == ["No."] * 8
    assert got[2] == rows[1][1] and got[3].strip() == "else"


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_unit_places(unit):
    text = "One two three.  Four five six!\nSeven eight nine\n\n \nTen eleven twelve. "
    found = [text[s:e] for s, e, _ in unit_dedup.units(text, unit, 3)]
    assert found[0].startswith("One") and found[-1].strip() == "Ten eleven twelve."
    assert len(found) == {"line": 3, "paragraph": 2, "sentence": 5}[unit]


def test_index_against_search():
    rng = random.Random(4)
    for _ in range(40):
        depth = rng.choice([7, 8, 13, 20])
        texts = {
            bytes(rng.choice(b"ab") if rng.random() < 0.5 else 97 for _ in range(rng.randint(depth, 45)))
            for _ in range(rng.randint(1, 10))
        }
        texts = sorted(texts, key=hash)
        weights = np.array([rng.randint(0, 9) for _ in texts])
        lengths = np.array([len(t) for t in texts])
        index = run_index.build(np.frombuffer(b"".join(texts), np.uint8), lengths, weights, depth)
        best, count = run_index.stream(index, lengths)
        at = 0
        for text in texts:
            for j in range(len(text)):
                held = [w for t, w in zip(texts, weights) for q in range(len(t) - depth + 1) if t[q : q + depth] == text[j : j + depth]]
                assert count[at] == (len(held) if j + depth <= len(text) else 0)
                assert not count[at] or best[at] == min(held)
                at += 1


def brute_substrings(rows):
    first = {}
    for doc, data in sorted(rows):
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], doc)
    out = []
    for doc, data in rows:
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < doc:
                gone[p : p + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def report(docs):
    return sorted(
        (LAST_ID if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in substring_dedup.substring_report(docs).collect()
    )


@pytest.mark.parametrize("block", [1 << 22, 3000])
def test_substrings_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 40_000)
    monkeypatch.setattr(substring_dedup, "INDEX_BYTES", 5_000)
    rng = random.Random(1)
    passage = prose(77, 40)
    rows = [r for r in odd_rows() if r[0] != 103]
    rows += [(300 + n, prose(n, 30) + passage[rng.randint(0, 50) :] + "é" * rng.randint(0, 60), "en", "a", 1) for n in range(60)]
    rows += [(400, "ab" * 400, "en", "a", 1), (401, "x" + "ab" * 300, "en", "a", 1), (402, "a" * 49, "en", "a", 1), (403, "a" * 49, "en", "a", 1)]
    want = brute_substrings([(LAST_ID if d is None else d, (t or "").encode()) for d, t, *_ in rows])
    assert report(frame(spark, rows, clashes=True)) == want


def test_substrings_of_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert report(docs) == brute_substrings([(r.doc_id, r.text.encode()) for r in docs.collect()])


def edited(text, edits, rng):
    letters = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(letters)), rng.choice("sid")
        if kind == "s":
            letters[at] = "#"
        elif kind == "d":
            del letters[at]
        else:
            letters.insert(at, "#")
    return "".join(letters)


def slow_edits(piece, text):
    """Fewest edits of ``piece`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(piece, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_passages_as_by_full_alignment():
    rng = random.Random(6)
    items = [(n, prose(900 + n, 12).upper()) for n in range(8)]
    index = decontaminate.build_index(items)
    for n in range(60):
        item = decontaminate.normalise(rng.choice(items)[1])
        cut = rng.randint(0, max(0, len(item) - 70))
        part = edited(item[cut : cut + rng.randint(50, 90)], rng.randint(0, 9), rng)
        text = decontaminate.normalise(prose(n, 15)[: rng.randint(0, 90)] + part + prose(n + 70, 6))
        found = {item for item, *_ in decontaminate.matches(index, text)}
        want = {
            index.items[p]
            for p, piece in enumerate(index.pieces)
            if slow_edits(piece, text) <= index.edits[p]
        }
        assert found == want, (n, part)


def test_benchmark_in_blocks_and_odd_rows(spark, monkeypatch):
    items = [(n, prose(900 + n, 14)) for n in range(6)] + [(50, None), (51, ""), (52, "short"), (None, prose(1, 60))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = odd_rows() + [(700 + n, prose(n, 30) + "\n" + prose(900 + n, 14).upper() + " tail", "en", "a", 1) for n in range(6)]
    docs = frame(spark, rows, clashes=True)
    # The item without an id is the text of document 1, and 701 begins like it.
    want = {(700 + n, n) for n in range(6)} | {(1, None), (701, None)}
    whole = {(r.doc_id, r.item_id) for r in decontaminate.passage_report(docs, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    split = {(r.doc_id, r.item_id) for r in decontaminate.passage_report(docs, benchmark).collect()}
    assert whole == split == want
    none = benchmark.limit(0)
    assert decontaminate.passage_report(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == len(rows)
    assert decontaminate.drop_contaminated(docs, benchmark).count() == len(rows) - 7


def test_portions_of_pairs_give_the_same_passages(monkeypatch):
    rng = random.Random(7)
    items = [(n, prose(900 + n, 14)) for n in range(8)] + [(9, "ab" * 90), (None, "a" * 200)]
    index = decontaminate.build_index(items)
    texts = []
    for n in range(25):
        parts = [edited(rng.choice(items)[1], rng.randint(0, 6), rng) if rng.random() < 0.5 else prose(n, 9) for _ in range(6)]
        texts.append(" ".join(parts))
    whole = [decontaminate.matches(index, t) for t in texts]
    for pairs in (1, 40, 500):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        assert [decontaminate.matches(index, t) for t in texts] == whole
    assert sum(map(len, whole)) > 50


def test_a_megabyte_of_one_letter():
    import tracemalloc

    index = decontaminate.build_index([(1, "a" * 200), (2, prose(1, 30))])
    tracemalloc.start()
    found = decontaminate.matches(index, "a" * 1_000_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(f[0], f[3]) for f in found] == [(1, 0)] and found[0][2] - found[0][1] > 999_000
    assert peak < 600 << 20


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    import gc
    import weakref

    held, alive, build = [], [], decontaminate.build_index

    def counted(items):
        gc.collect()
        alive.append(sum(ref() is not None for ref in held))
        index = build(items)
        held.append(weakref.ref(index))
        return index

    monkeypatch.setattr(decontaminate, "build_index", counted)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    benchmark = spark.createDataFrame([(n, prose(900 + n, 14)) for n in range(6)], "item_id long, text string")
    docs = frame(spark, [(n, prose(900 + n, 14), "en", "a", 1) for n in range(6)])
    assert {(r.doc_id, r.item_id) for r in decontaminate.passage_report(docs, benchmark).collect()} == {(n, n) for n in range(6)}
    assert len(alive) > 2 and not any(alive)


@pytest.mark.parametrize("size", [64, 70, 84])
def test_exact_quotations_are_found_at_every_offset(size):
    item = decontaminate.normalise(prose(950, 30))
    index = decontaminate.build_index([(1, item)])
    for at in range(len(item) - size + 1):
        text = f"{'#' * 80}{item[at : at + size]}{'@' * 80}"
        assert [m[0] for m in decontaminate.matches(index, text)] == [1], at
