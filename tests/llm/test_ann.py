"""Tree search against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scrubline.llm import ann, queries

SF = "/root/testdata/sf0.1"


def exact(ids, x, i, k):
    s = np.array([sum(a * b for a, b in zip(x[i].tolist(), y.tolist())) if j != i else -np.inf for j, y in enumerate(x)])
    return [int(ids[j]) for j in np.lexsort((ids, -s))[:k]], s


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 50)  # 40 leaves: the tree is searched, not read whole
    monkeypatch.setattr(ann, "CHUNK_ROWS", 64)
    seen = []
    real = ann.calibrate
    monkeypatch.setattr(ann, "calibrate", lambda *a: seen.append((real(*a), a[1].n_leaves)) or seen[-1][0])
    got = {}
    for r in queries.op9_ann(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pandas()
    x, ids = np.array(t.embedding.tolist(), dtype=np.float64), t.vec_id.to_numpy()
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    assert seen[0][0][0] < seen[0][1]
    hit = 0
    for i in np.flatnonzero(ids % 20 == 0):
        truth, s = exact(ids, x, i, 20) if i % 200 == 0 else ([int(ids[j]) for j in np.argsort(-np.where(np.arange(len(x)) == i, -9, x @ x[i]))[:20]], None)
        rows = got[ids[i]]
        assert sorted(rows) == list(range(1, 21))
        hit += len(set(truth) & {v for v, _ in rows.values()})
        if s is not None:
            assert all(score == pytest.approx(s[v], abs=1e-12) for v, score in rows.values())
    assert hit / (20 * len(got)) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [2.0, 0.0]), (20, [2.0, 0.0]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "q", 1) for i, v in rows], "vec_id long, embedding array<double>, query string, leaf int")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(20, 2.0), (20, 2.0), (1, 0.5), (2, 0.5), (40, -1.0)], 20: [(0, 2.0), (1, 1.0), (2, 1.0), (40, -2.0)],
                   40: [(1, -0.5), (2, -0.5), (0, -1.0), (20, -2.0), (20, -2.0)]}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.filter("vec_id = 3"), F.col("vec_id") % 20 == 0).count() == 0


def test_hot_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, ([1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist())) for i in range(3000)]
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert len(got) == 150
    same = [i for i, v in rows if i % 3 == 0]
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    hits = sum(len(set(got[q].values()) & set(np.lexsort((np.arange(3000), -np.where(np.arange(3000) == q, -1e9, x @ x[q])))[:5].tolist())) for q in got)
    assert hits >= 0.9 * 5 * 150
    assert list(got[60].values()) and set(got[60].values()) <= set(range(3000)) and len(same) == 1000


def test_small_leaves(spark, monkeypatch):
    """One visit and leaves of about ten rows: the search goes on until it has k rows, or all that there are."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 10)
    monkeypatch.setattr(ann, "calibrate", lambda *a: (1, 1.0))
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(20, rng.normal(size=8).tolist())] * 5  # an id that is repeated
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k, want in ((20, 20), (500, None)):
        got = {}
        for r in ann.search(df, F.col("vec_id") % 20 == 0, k=k).collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert set(got) == set(range(0, 400, 20))
        assert all(len(v) == (want or (399 if q == 20 else 404)) and q not in v for q, v in got.items())
