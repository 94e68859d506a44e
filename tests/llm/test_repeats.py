"""Repeated byte strings and word windows against brute force."""

import hashlib
import random

import numpy as np
import pytest

from scrubline.llm import queries, recompress, repeats, suffixdedup

from ..conftest import SF_SMALL
from . import brute


def byte_results(texts, width=200):
    raws = [(t or "").encode() for t in texts]
    out = []
    for raw, gone in zip(raws, brute.repeated_windows(raws, width)):
        spans = sum(i - 1 not in gone for i in gone)
        kept = bytes(b for i, b in enumerate(raw) if i not in gone)
        out.append((len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def hard():
    """Shared passages at all offsets, edited copies, runs, periods, near-width strings, odd texts."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60) for _ in range(6)]
    texts = [None, "", " ", "x" * 199, "x" * 200, "y" * 201, "z" * 1000, "ab" * 400, "é" * 150, "\0" * 300]
    for _ in range(60):
        t = prose(rnd.randint(0, 50))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a, b = sorted(rnd.sample(range(len(p)), 2))
            t += p[a:b] + prose(rnd.randint(0, 30))
        texts.append(t)
    base = prose(120)
    for _ in range(20):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice("#@")
        texts.append("".join(w))
    for n in (198, 199, 200, 201, 202):
        s = "".join(rnd.choice("abcdefgh") for _ in range(n))
        texts += ["<" + s + ">", "[" + s + "]"]
    return texts


def run_bytes(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, pos int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.report(df).collect()}
    return df, [got[i] for i in range(len(texts))]


def test_bytes_hard(spark, hard):
    df, got = run_bytes(spark, hard)
    want = byte_results(hard)
    assert got == want
    out = {r.doc_id: r for r in suffixdedup.dedup(df).collect()}
    assert list(out[0].asDict()) == df.columns and out[0].text is None and len(out) == len(hard)
    for i, t in enumerate(hard):
        if t and t.isascii():
            assert len(out[i].text) == want[i][0] - want[i][1]


def test_bytes_hot_buckets_and_long_texts(spark, hard, monkeypatch):
    monkeypatch.setattr(suffixdedup, "HOT", 2)
    assert run_bytes(spark, hard)[1] == byte_results(hard)
    monkeypatch.setattr(suffixdedup, "HOT", 1024)
    rnd = random.Random(1)
    long = "".join(rnd.choice("abc \n") for _ in range(repeats.CHUNK + 50_000))
    texts = [long, "q" * 30 + long[repeats.CHUNK - 400:repeats.CHUNK + 400], long[1000:1500] + "!", "n" * 50]
    assert run_bytes(spark, texts)[1] == byte_results(texts)


def test_bytes_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_dedup(spark, SF_SMALL).collect()}
    assert got == dict(zip((r.doc_id for r in rows), byte_results([r.text for r in rows])))


def test_bytes_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "r" * 300 + "s")] * 3, "doc_id long, text string")
    assert {(r.n_removed, r.n_spans) for r in suffixdedup.report(df).collect()} == {(301, 1)}
    assert suffixdedup.report(df.limit(0)).count() == 0


def test_corpus_order_equals_plain_comparison():
    rnd = random.Random(9)
    left = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 6))).encode() for _ in range(80)]
    right = [("x" * 105 + "".join(rnd.choice("ab") for _ in range(rnd.choice([95, 95, 95, 93])))).encode() for _ in range(80)]
    right = [right[rnd.randrange(8)] if rnd.random() < 0.7 else r for r in right]
    key = np.array([rnd.randint(0, 2) for _ in range(80)])
    far = np.array([len(x) for x in left])
    near = np.array([200 - len(r) for r in right])
    far = np.maximum(far, 0)
    hit = suffixdedup.corpus_order(key, left, right, far, near)
    seen = {}
    for i in range(80):
        for n in range(near[i], far[i] + 1):
            s = left[i][len(left[i]) - n:] + right[i][:200 - n]
            seen.setdefault((key[i], n, s), []).append(i)
    want = np.zeros_like(hit)
    for (_, n, _), rows in seen.items():
        if len(rows) > 1:
            want[rows, n] = True
    assert (hit == want).all()


def word_results(texts, width=35):
    seqs = [brute.words(t) for t in texts]
    out = []
    for w, gone in zip(seqs, brute.repeated_windows(seqs, width)):
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def run_words(spark, texts):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, loc int").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in recompress.report(df).collect()}
    return df, [got[i] for i in range(len(texts))]


def test_words_hard(spark):
    rnd = random.Random(8)
    prose = lambda n: [f"w{int(rnd.paretovariate(0.7)) % 500}" for _ in range(n)]
    passages = [prose(70) for _ in range(6)]
    texts = [None, "", " \n", "a", "a " * 34, "a " * 35, "b " * 36, "c " * 200, "d e " * 60, "f g h\t" * 50, "é\x85日 " * 40]
    for _ in range(120):
        w = prose(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            i, j = sorted(rnd.sample(range(len(p)), 2))
            w += p[i:j] + prose(rnd.randint(0, 20))
        texts.append(rnd.choice([" ", "\n", "  "]).join(w))
    base = prose(150)
    for _ in range(20):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = "new"
        texts.append(" ".join(w))
    for n in range(33, 38):
        s = [f"u{n}_{i}" for i in range(n)]
        texts += [" ".join(["<", *s, ">"]), " ".join(["[", *s, "]"])]
    df, got = run_words(spark, texts)
    want = word_results(texts)
    assert got == want
    out = {r.doc_id: r for r in recompress.dedup(df).collect()}
    assert out[0].text is None and out[2].text == " \n" and list(out[0].asDict()) == df.columns
    assert all(len(brute.words(out[i].text)) == w[0] - w[1] for i, w in enumerate(want))


def test_words_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    monkeypatch.setattr(recompress, "CHUNK", 1000)
    rnd = random.Random(1)
    long = [f"w{rnd.randint(0, 30)}" for _ in range(5000)]
    texts = [" ".join(long), " ".join(["q"] * 30 + long[960:1040] + ["z"]), " ".join(long[3000:3040] + long[10:50]), "n " * 3000]
    assert run_words(spark, texts)[1] == word_results(texts)


def test_words_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_recompression(spark, SF_SMALL).collect()}
    assert got == dict(zip((r.doc_id for r in rows), word_results([r.text for r in rows])))


def test_words_empty(spark):
    df = spark.createDataFrame([(1, "r " * 40)], "doc_id long, text string")
    assert [r.n_removed for r in recompress.report(df).collect()] == [40]
    assert recompress.report(df.limit(0)).count() == 0


def test_equal_texts_have_equal_interior_symbols():
    rnd = random.Random(3)
    core = [rnd.randint(0, 2**63) for _ in range(300)]
    found = []
    for _ in range(4):
        side = lambda: [rnd.randint(0, 2**63) for _ in range(rnd.randint(0, 40))]
        left = side()
        names = np.array(left + core + side(), np.uint64)
        found.append([{(p - len(left), n) for p, a, z, n in zip(*(x.tolist() for x in level))
                       if a >= len(left) and z <= len(left) + len(core)} for level in recompress.rounds(names, 4)])
    assert all(f == found[0] for f in found) and all(len(x) > 20 for x in found[0])
