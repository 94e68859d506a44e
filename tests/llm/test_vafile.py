"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubline.llm import vafile


def brute(rows, k, scale=64):
    """rows: (vec_id, vector) -> {query: [(vec_id, score)]}"""
    ok = [(i, [math.floor(scale * x) if math.isfinite(scale * x) else scale * int(x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q in sorted({i for i, _ in ok if i % 20 == 0}):
        def key(v):  # the bytes of the vector: 32 bits each, little end first, or decimal text
            return (len(v), any(abs(x) > 1 << 20 for x in v), np.array(v).astype("<i4").tobytes() if all(abs(x) < 1 << 31 for x in v) else str(v))
        mine = min((v for i, v in ok if i == q), key=key)
        scored = [(-min(max(sum(a * b for a, b in zip(mine, v)), vafile.LONG[0]), vafile.LONG[1]), i) for i, v in ok if i != q and len(v) == len(mine)]
        if scored:
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def got(df, k, **how):
    out = {}
    for r in vafile.search(df, F.col("vec_id") % 20 == 0, k, **how).orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def frame(spark, rows, kind="array<double>"):
    return spark.createDataFrame([(i, v, "x", b"") for i, v in rows], f"vec_id long, embedding {kind}, query_id string, qkey binary").repartition(3)


@pytest.mark.parametrize("block", [50, 8192])
def test_random(spark, monkeypatch, block):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 7)
    rng = np.random.default_rng(1)
    rows = [(int(i), (rng.normal(size=12) / 3).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.25] * 12) for i in range(300)]  # a third are copies
    rows += [(2000 + i, (rng.integers(-1, 2, size=12) / 64).tolist()) for i in range(200)]  # many ties
    assert got(frame(spark, rows), 9) == brute(rows, 9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]),
            (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [2.0, 0.0]), (20, [2.0, 0.0]), (40, [-1.0, 0.01]), (60, []), (61, []), (80, [1.0, 2.0, 1.0]),
            (9, [1e300, -1.0]), (10, [-1e20, 3.0]), (11, [1.7e308, 0.1]), (100, [4e5, 1e-300]), (120, [-0.001, 1e25])]
    rows += [(140, [float(i), 1.0]) for i in range(30)]  # one id with many vectors
    assert got(frame(spark, rows), 4) == brute(rows, 4)
    assert got(frame(spark, rows), 50) == brute(rows, 50)
    assert got(frame(spark, rows, "array<float>").filter("vec_id != 11"), 4)


def test_wide_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5000).tolist()) for i in range(0, 60, 10)]
    assert got(frame(spark, rows), 3) == brute(rows, 3)


def test_empty_and_lonely(spark):
    some = frame(spark, [(0, [1.0])])
    assert got(some, 3) == {} and got(some.limit(0), 3) == {} and got(frame(spark, [(1, [1.0]), (2, [2.0])]), 3) == {}


def test_cells_rule_out():
    """The bounds spare most exact reads, and never a row that belongs to the result."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = np.floor(64 * (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) / 10)).astype("<i4")
    cells, low, high = vafile.cells_of(x.astype(float))
    ids = np.arange(4000, dtype="<i8")
    block = vafile.Block(dict(dim=16, n=4000, wide=False, cells=cells.tobytes(), low=low.tobytes(), high=high.tobytes()),
                         dict(vectors=x.tobytes(), ids=ids.tobytes(), counts=np.ones(4000, "<i8").tobytes(), places=np.arange(4001, dtype="<i8").tobytes()))
    q = x[:32].astype(float)
    upper, lower = block.bounds(q)
    scores = q @ x.T.astype(float)
    assert (lower <= scores).all() and (scores <= upper).all()
    read = []
    best = [vafile.Best(20) for _ in q]

    class Counting(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.append(len(at))
            return np.asarray(self).__getitem__(at)

    block.vectors = block.vectors.view(Counting)
    block.search(q, best)
    assert sum(read) < 0.3 * 32 * 4000
    for i, b in enumerate(best):
        want = sorted(zip(-scores[i], ids))[:21]
        assert [(-s, v) for s, v, _ in b.rows] == want
