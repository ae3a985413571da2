"""Token alignment, periodic runs and byte-pair encoding against brute force and the libraries."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablewarden.llm import packing, perfect_hash, periodic_runs, speculative_bpe, token_alignment
from texts_fixture import frame, odd_rows, prose

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|>", "a <|endoftext|> b\n\n<|endoftext|><|endoftext|>", "x▁y", "tab\tand  two", "  \u0085 z",
       "日本語 текст ñ\U0001f600", "it's we'll '' 's", "á ‍", "<0x41> <s> </s>", "\x01\x02"]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def rows_with(texts):
    return odd_rows() + [(500 + n, t, "en", "a", 1) for n, t in enumerate(texts)]


# Byte-pair encoding


@pytest.fixture(scope="module")
def codec():
    return speculative_bpe.Codec(BYTES)


def library_ids(texts):
    return [e.ids for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_those_of_the_library(codec):
    rng = random.Random(1)
    pools = ["abcaaa  \n\t'sré日.-=", ["a", "aa", "ab", "<|endoftext|>", " ", "th", "e", "in", "the", "ing"]]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for pool in pools for _ in range(3000)]
    texts += [unit * n for unit in ("a", "-", " ", "ab", "=-", "\n ") for n in range(150)] + ODD
    got = [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)]
    assert got == library_ids(texts)


def test_every_character_splits_as_in_the_library(codec):
    texts = [f"a{chr(c)}1 {chr(c)}b" for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000]
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)] == library_ids(texts)


def test_verification_rejects_just_the_wrong_proposals(codec):
    """A proposal is kept if and only if merging step by step gives the same."""
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aeinrst-=") for _ in range(rng.randint(2, 14))) for _ in range(4000)]
    words += [word for word, n in list(codec.ids.items())[::97] if len(word) > 1]
    found, failed = codec.encode_words(words)
    merged = [codec.merge(word) for word in words]
    as_bytes = [[codec.ids[word[n : n + 1]] for n in range(len(word))] for word in words]
    assert merged == [codec._merge_long(ids) for ids in as_bytes]
    assert found == merged
    assert failed == sum(codec.propose(word) != m for word, m in zip(words, merged)) > 100
    assert failed < len(words) * 0.9


def test_decoding_gives_the_library_text(codec):
    rng = random.Random(3)
    library = Tokenizer.from_file(BYTES)
    for _ in range(300):
        ids = [rng.randrange(codec.size) for _ in range(rng.randint(0, 9))]
        want = library.decode(ids, skip_special_tokens=False)
        assert codec.decode(np.array(ids, "<u4").tobytes()) == want


def test_a_long_text_is_split_where_words_begin(codec, monkeypatch):
    texts = [prose(5, 3000), "a  b   c " * 2000, "a" * 30_000, " " * 20_000 + "x"]
    want = library_ids(texts)
    monkeypatch.setattr(speculative_bpe, "CHUNK_CHARS", 64)
    monkeypatch.setattr(speculative_bpe, "CHUNK_WORDS", 50)
    monkeypatch.setattr(speculative_bpe, "CACHE_WORDS", 10)
    assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)] == want
    assert len(codec.encode(["ab" * 500_000])[0]) > 0


def test_round_trip_report_on_odd_rows(spark):
    rows = rows_with(ODD)
    got = speculative_bpe.round_trip_report(frame(spark, rows, clashes=True), BYTES).collect()
    texts = [r[1] or "" for r in rows]
    want = [
        (r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))
        for r, text, ids in zip(rows, texts, library_ids(texts))
    ]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert speculative_bpe.round_trip_report(frame(spark, []), BYTES).count() == 0


def test_documents_come_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    encoded = speculative_bpe.encode_documents(docs, BYTES)
    back = {r.doc_id: r.text for r in speculative_bpe.decode_documents(encoded, BYTES).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


def test_other_vocabularies_are_refused(tmp_path):
    import json

    spec = json.load(open(BYTES, encoding="utf-8"))
    spec["model"]["merges"][0], spec["model"]["merges"][9000] = spec["model"]["merges"][9000], spec["model"]["merges"][0]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        speculative_bpe.Codec(str(path))


# Periodic runs


def slow_runs(words):
    """All runs, by following each distance from each place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(24, 3 * q):
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def periodic_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        letters = rng.choice([1, 2, 3, 50])
        words = [str(rng.randint(0, letters)) for _ in range(rng.randint(0, 140))]
        for _ in range(rng.randint(0, 3)):
            cycle = [str(rng.randint(0, letters)) for _ in range(rng.randint(1, 20))] * rng.randint(2, 9)
            at = rng.randint(0, len(words))
            words[at:at] = cycle[: rng.randint(0, len(cycle))]
        yield words


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_runs_against_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(periodic_runs, "BLOCK", 8)
    texts = [[w.encode() for w in words] for words in periodic_texts(4, 600)]
    want = [slow_runs(words) for words in texts]
    assert list(periodic_runs.find_runs(texts)) == want
    assert sum(map(len, want)) > 200


def test_long_periodic_texts():
    for words in ([b"a"] * 200_000, ([b"a", b"b", b"c"] * 4 + [b"d"]) * 9_000):
        ((start, length, period),) = list(periodic_runs.find_runs([words]))[0]
        assert (start, length) == (0, len(words)) and period in (1, 13)


def run_row(doc, text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc is not None and words and zlib.crc32(str(doc).encode()) % 10 == 0:
        g, n = zlib.crc32(str(doc).encode()) // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = slow_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc, len(runs), *best, milli, sha(lines.encode()), sha(left.encode()))


def test_run_report_against_brute_force(spark):
    rows = [r for r in rows_with(ODD) if r[0] != 103]
    rows += [(1000 + n, " ".join(w), "en", "a", 1) for n, w in enumerate(periodic_texts(6, 150))]
    got = periodic_runs.run_report(frame(spark, rows, clashes=True)).collect()
    want = [run_row(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert periodic_runs.run_report(frame(spark, [])).count() == 0


def test_collapsed_text_and_runs(spark):
    text = "start " + "one two three " * 10 + "end"
    row = periodic_runs.periodic_runs(frame(spark, [(1, text, "en", "a", 1)])).first()
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)]
    assert row.collapsed == "start one two three end"


# Alignment


@pytest.mark.parametrize("count", [1, 2, 1000, 30_000])
def test_perfect_hash(count):
    rng = np.random.default_rng(count)
    keys = np.unique(rng.integers(0, 1 << 40, count))
    sizes, bits, placed = perfect_hash.build_bucket(keys)
    words = np.array([sizes], np.int64).reshape(1, -1)
    held = np.frombuffer(bits.tobytes(), "<u8") if len(keys) else np.array([], np.uint64)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(held))])[:-1].astype(np.int64)
    begin = np.cumsum(words, axis=1) - words
    table = perfect_hash.Table(0, 0, words, begin, held, before, placed)
    assert sorted(table.index(keys).tolist()) == list(range(len(keys)))
    assert (placed[table.index(keys)] == keys).all()
    assert (table.index(np.arange(1 << 41, (1 << 41) + 500)) == -1).all()


def alignment_rows(rows):
    """The report by two pointers over the tokens of the two libraries."""
    first = Tokenizer.from_file(BYTES)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = packing.byte_of_letter()
    a_bytes = {n: bytes(letters[c] for c in w) for w, n in first.get_vocab().items() if n != 50256}

    def b_bytes(n):
        piece = second.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(n) else piece.replace("▁", " ").encode()

    parts, docs = [], Counter()
    for doc, text, *_ in rows:
        a, b = [], []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            whole = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) != whole or b"".join(map(b_bytes, b)) != whole:
                a, b = [], []
        links, groups, i, j, i0, j0, x, y = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = x + len(a_bytes[a[i]]), y + len(b_bytes(b[j]))
            if end_a <= end_b:
                x, i = end_a, i + 1
            if end_b <= end_a:
                y, j = end_b, j + 1
            if end_a == end_b:
                groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
                i0, j0 = i, j
        parts.append((doc, len(a), len(b), groups, links))
        docs.update(set(links))
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(n, best.get(a, 0))
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(docs[x] == best[x[0]] for x in links), sum(docs[x] for x in links),
         sha(";".join(groups).encode()) if groups else "")
        for doc, n_a, n_b, groups, links in parts
    ]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_two_pointers(spark, monkeypatch, small):
    if small:
        # Several buckets, blocks and levels of sums.
        for module, name, value in (
            (perfect_hash, "BUCKET_KEYS", 100),
            (perfect_hash, "BLOCK_KEYS", 500),
            (token_alignment, "CHUNK_BYTES", 3000),
            (token_alignment, "TASK_PAIRS", 300),
            (token_alignment, "ROW_COUNTS", 64),
            (token_alignment, "FAN_IN", 2),
        ):
            monkeypatch.setattr(module, name, value)
    rows = rows_with(ODD)
    docs = frame(spark, rows, clashes=True).repartition(7)
    got = token_alignment.alignment_report(docs, BYTES, PIECES).collect()
    assert sorted(map(tuple, got), key=key) == sorted(alignment_rows(rows), key=key)


def test_alignment_of_nothing(spark):
    assert token_alignment.alignment_report(frame(spark, []), BYTES, PIECES).count() == 0
    rows = [(1, None, "en", "a", 1), (2, "", "en", "a", 1)]
    got = token_alignment.alignment_report(frame(spark, rows), BYTES, PIECES).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_of_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = token_alignment.alignment_report(docs, BYTES, PIECES).collect()
    assert sorted(map(tuple, got)) == sorted(alignment_rows([(r.doc_id, r.text) for r in docs.collect()]))
