"""Classifiers by held-out accuracy, the tagger by its gradient and spans, packing by round trip."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewarden.llm import packing, pii, quality_model, tagger, toxicity, word_vectors
from tablewarden.llm.queries import QUERIES
from texts_fixture import frame

BIG = "/root/testdata/sf0.1"
# Fixed value: the base pattern of an address.
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@pytest.mark.parametrize(
    "name, label, bar", [("op1_quality_classifier", "quality", 0.95), ("op5_toxicity", "toxic", 0.965)]
)
def test_held_out_accuracy(spark, name, label, bar):
    got = QUERIES[name](spark, BIG).collect()
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [(marks[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in marks]
    assert np.mean([a == b for a, b in held]) > bar


def test_training_never_sees_held_out_labels(spark):
    """Turning every held-out label round changes no score."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality",
        "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - toxic, toxic) AS toxic",
    )
    for run in (quality_model.quality_scores, toxicity.toxicity_scores):
        before = sorted((r.doc_id, r.score) for r in run(docs, labels).collect())
        assert before == sorted((r.doc_id, r.score) for r in run(docs, turned).collect())


@pytest.mark.parametrize("run", [quality_model.quality_scores, toxicity.toxicity_scores])
def test_classifiers_on_odd_rows(spark, run):
    docs = frame(spark, clashes=True)
    rows = [(n, n % 2, n % 2) for n in range(20)] + [(100, 1, 0), (None, 1, 1), (7, None, 2), (10**9, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = run(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by_text = collections.defaultdict(set)
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    for r in got:
        by_text[r.doc_id].add(r.score)
    assert by_text[100] == by_text[101] and texts
    none = run(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert run(docs.limit(0), labels).count() == 0


def test_words_share_a_bucket_wherever_they_lie():
    first, starts = word_vectors.word_buckets(np.frombuffer(b"the cat sat the cat", np.uint8))
    second, _ = word_vectors.word_buckets(np.frombuffer(b"  cat\n\tthe sat", np.uint8))
    assert starts.tolist() == [0, 4, 8, 12, 16]
    assert first[0] == first[3] == second[1] and first[1] == second[0] and first[2] == second[2]


def test_word_vectors_are_sums_over_neighbours(spark):
    rng = random.Random(1)
    texts = ["a b c d", "b c", "", None, "a", "  ", "d\n d"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    signs = word_vectors.index_vectors().astype(float)
    at = {w: int(word_vectors.word_buckets(np.frombuffer(w.encode(), np.uint8))[0][0]) for w in "abcdefgh"}
    want = np.zeros_like(signs)
    for text in texts:
        words = (text or "").split()
        for i, word in enumerate(words):
            for j in range(max(0, i - word_vectors.REACH), min(len(words), i + word_vectors.REACH + 1)):
                if i != j:
                    want[at[word]] += signs[at[words[j]]]
    for parts in (1, 4, 37):
        docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
        table = word_vectors.word_vectors(docs)
        assert np.allclose(table, word_vectors.unit(want))
    assert np.abs(want).sum() > 0


def test_scores_do_not_depend_on_the_partitions(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.unionByName(labels.selectExpr("doc_id", "1 - quality AS quality", "toxic").where("doc_id % 3 = 0"))
    found = [
        sorted((r.doc_id, r.score) for r in quality_model.quality_scores(docs.repartition(n), labels.repartition(n)).collect())
        for n in (1, 4, 37)
    ]
    for other in found[1:]:
        assert [d for d, _ in other] == [d for d, _ in found[0]]
        # Products of matrices of differing heights may differ in the last bit.
        assert np.allclose([s for _, s in other], [s for _, s in found[0]], rtol=0, atol=1e-12)
    assert len({score for _, score in found[0]}) > 50


def test_tagger_gradient():
    rng = np.random.default_rng(0)
    weights = tagger.init()
    codes = rng.integers(0, tagger.CODES, (3, 7))
    gold = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [7, 8, 8, 0, 5, 6, 0]])
    _, grads = tagger.loss_and_grads(weights, codes, gold)
    for name, w in weights.items():
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in w.shape)
            if name in ("xf", "xb"):
                at = (int(codes[rng.integers(0, 3), rng.integers(0, 7)]), at[1])
            if name == "step" and tagger.ALLOWED[at] < 0:
                continue
            kept, step = w[at], 1e-5
            w[at] = kept + step
            high, _ = tagger.loss_and_grads(weights, codes, gold)
            w[at] = kept - step
            low, _ = tagger.loss_and_grads(weights, codes, gold)
            w[at] = kept
            assert abs((high - low) / (2 * step) - grads[name][at]) < 1e-5


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(3)
    filler = "some words of plain text with nothing in them but version 3.0 and item 42".split()
    make = [
        lambda: f"{rng.choice(['ann', 'bob.x', 'carl'])}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        lambda: rng.choice(["4111111111111111", "5500005555555559", "4012888888881881"]),
        lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    ]
    windows = []
    for n in range(500):
        text = " ".join(rng.choice(filler) for _ in range(25)) + " " + make[n % 4]() + " " + " ".join(rng.choice(filler) for _ in range(25))
        windows += list(pii.training_windows(text, n))
    return pii.learn(windows)


def test_tagger_finds_what_patterns_miss(weights):
    text = "some words of plain text (415) 555-2671 with nothing in them " * 9
    (base, spans), = pii.all_spans([text], weights)
    assert not base and {text[s:e] for _, s, e in spans} <= {"(415) 555-2671"} and len(spans) >= 8


def test_windows_without_a_digit_change_nothing(weights):
    rng = random.Random(2)
    texts = []
    for n in range(40):
        words = [rng.choice(["plain", "words", "here", "bob@x.org", "10.2.3.4", "415-555-2671", "7"]) for _ in range(rng.randint(0, 200))]
        texts.append(" ".join(words) + " " + "nothing at all " * rng.randint(0, 60))
    assert pii.all_spans(texts, weights) == pii.all_spans(texts, weights, every=True)


def slow_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [
        ("card", *m.span()) for m in pii.CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))
    ]
    return found + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]


def test_base_patterns_with_shortcuts():
    rng = random.Random(9)
    texts = ["a@b.c@d.e", "@@x@y.z", "a.b@c", "é@x.y a%b@c-d.e.", "1.2.3.4.5.6.7.8", "001.2.3.4 256.1.1.1", "+1+2 34567890", ""]
    texts += ["".join(rng.choice("ab@.+-() 019") for _ in range(60)) for _ in range(3000)]
    for text in texts:
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == slow_base(text), text


def test_pii_on_odd_rows(spark):
    rows = [(1, "mail bob@x.org or 10.0.0.1", "en", "a", 1), (1, "mail bob@x.org or 10.0.0.1", "en", "a", 1)]
    docs = frame(spark, clashes=True).unionByName(frame(spark, rows, clashes=True))
    got = pii.pii_report(docs).collect()
    assert len(got) == docs.count()
    assert sum(r.n_email for r in got) == 2 and sum(r.n_ip for r in got) >= 2
    assert pii.pii_report(docs.limit(0)).count() == 0
    bare = frame(spark, [(1, "no digits at all", "en", "a", 1), (2, None, "en", "a", 1)])
    assert {r.spans for r in pii.pii_report(bare).collect()} == {""}


def test_pieces_and_places(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(7, "text with <|endoftext|> in it  and\n\n spaces", "en", "a", 1), (8, "x " * 1022, "en", "a", 1), (9, "x " * 1023, "en", "a", 1)]
    docs = frame(spark, clashes=True).unionByName(frame(spark, rows, clashes=True))
    got = packing.pack(docs, path).collect()
    whole = Tokenizer.from_file(path)
    want = collections.Counter()
    for r in docs.collect():
        ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or 1024
        for n, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : start + (first if n == 0 else 1024)]
            want[(r.doc_id, n, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack(docs.limit(0), path).count() == 0


def test_plan_is_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(1, 20))}
        slots = packing.plan(counts, 64)
        room = {}
        for length in sorted(counts, reverse=True):
            own = [s for s in slots if s.length == length]
            assert sum(s.count for s in own) == counts[length]
            assert [s.rank for s in own] == [sum(x.count for x in own[:n]) for n in range(len(own))]
        for s in slots:
            for n in range(s.count):
                assert room.get(s.sequence + n, 0) == s.offset
                room[s.sequence + n] = s.offset + s.length
        assert max(room.values()) <= 64
        slow = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fits = [x for x in slow if x >= length]
                if fits:
                    slow.remove(min(fits))
                    slow.append(min(fits) - length)
                else:
                    slow.append(64 - length)
        assert len(room) == len(slow)


def test_addresses_in_long_runs_of_digits():
    import time

    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice("0129. a") for _ in range(rng.randint(0, 40)))
        want = []
        for m in ADDRESS.finditer(text):
            if all(int(p) <= 255 for p in m.group().split(".")):
                want.append((1, *m.span()))
        assert [s for s in pii.base_spans(text) if s[0] == 1] == want
    start = time.perf_counter()
    assert not [s for s in pii.base_spans("7" * 1_000_000) if s[0] == 1]
    assert [s for s in pii.base_spans("0" * 9000 + "1.2.3.4" + ".5" * 9) if s[0] == 1][0] == (1, 0, 9007)
    assert time.perf_counter() - start < 2


def test_the_tagger_learns_from_rare_spans(spark):
    """Two documents of 3,000 with digits hold a span: both are learned from."""
    rows = [(n, f"item {n} of {n + 7} in 19{n % 90 + 10}", "en", "a", 1) for n in range(3000)]
    rows += [(9000, "mail bob@site.example.org now", "en", "a", 1), (9001, "from 10.20.30.40 today", "en", "a", 1)]
    assert pii.fit(frame(spark, rows)) is not None
    got = {r.doc_id: r.spans for r in pii.pii_report(frame(spark, rows)).collect()}
    assert "email:5:25" in got[9000] and "ip:5:16" in got[9001]
