"""Near-duplicate components against all pairs by brute force."""

import random

import numpy as np
import pytest

from scrubline.llm import graph, neardup, queries

from ..conftest import SF_SMALL
from . import brute


def check(df, rows, share=85):
    got = neardup.link(df, share).collect()
    want = brute.components(rows, share)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return got


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_neardup(spark, SF_SMALL).collect()}
    assert got == brute.components(rows)


@pytest.fixture(scope="module")
def family():
    """A large family of edited copies: links, chains, strays, and short texts."""
    rnd = random.Random(4)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 6, 12])):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 10**6)}"
        rows.append(" ".join(w))
    rows += ["", None, " \n", "one two", "One TWO", "one two three four five", "one two three four five six", "é É"] * 2
    rows += ["long " + " ".join(f"v{rnd.randint(0, 10**5)}" for _ in range(30000))] * 2
    order = list(range(len(rows)))
    rnd.shuffle(order)
    return [(i, rows[j]) for i, j in enumerate(order)]


def test_family(spark, family, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 32)  # hot buckets are cut into many blocks
    df = spark.createDataFrame([(i, t, "x") for i, t in family], "doc_id long, text string, tkey string").repartition(5)
    check(df, family)
    check(df, family, 80)
    kept = neardup.dedup(df, 80)
    want = {i for i, (_, c) in brute.components(family, 80).items() if i == c}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want


def test_odd(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words are here now"), (None, "a b c d e f"), (0, None)],
                               "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.link(df).collect() if r.doc_id is not None)
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True)]
    assert neardup.link(df.limit(0)).count() == 0


def test_base_text_without_an_id(spark):
    """The unedited text of a family shares most buckets, so it is their centre: its set is needed though it has no id."""
    base = [f"w{i}" for i in range(150)]
    texts = [base] + [base[:at] + [f"x{at}"] + base[at + 1:] for at in range(7, 147, 10)]
    alone = [f"v{i}" for i in range(150)]  # a family without any id
    rows = [(i or None, " ".join(w)) for i, w in enumerate(texts)] + [(None, " ".join(alone)), (None, " ".join(alone[:-1]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.link(df).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 0), (0, 1)] + [(i, 1) for i in range(1, len(texts))]
    assert sorted((r.doc_id or 0, r.text[0]) for r in neardup.dedup(df).collect()) == [(0, "v"), (1, "w")]


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 5000):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        assert len(neardup.sketch(x, 180)) == 180
        y = np.concatenate([x[: n - n // 5], rng.integers(0, 2**63, n // 5).astype(np.uint64)])
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((neardup.sketch(x, 1800) == neardup.sketch(y, 1800)).mean() - true) < 0.06


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randint(100, 200), rnd.randint(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 350)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.k: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
