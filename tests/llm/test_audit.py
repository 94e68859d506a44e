"""Filter interaction audit against one pass of the filters per order."""

from collections import Counter
from itertools import permutations

import numpy as np

from scrubline.llm import audit, queries

from .brute import words

SF = "/root/testdata/sf0.01"


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic) -> {(part, order, step): counts}"""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)
    rows = []
    for d, text, source in docs:
        w, text = words(text), text or ""
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": d is not None and d > first[text]}
        rows.append((source or "", fails, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine, total = [r for r in rows if r[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                total[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(r[1][f] for r in mine) - len(gone),
                                          sum(r[1][f] and sum(r[1].values()) == 1 for r in mine),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in audit.COUNTS) for r in df.collect()}
    assert len(found) == df.count()
    return found


def test_odd_documents(spark):
    many = " ".join(f"w{i}" for i in range(250))
    docs = [(1, "short", "a"), (2, "short", "a"), (2, "short", "b"), (2, "short", "b"), (3, None, None), (4, "", ""), (5, "", "a"), (None, "short", "a"),
            (None, many, None), (6, many, "a"), (7, many + " #", "a"), (8, "LOUD " * 300, "b"), (9, "word " * 1_000_000, "b"), (10, "é" * 60 + "A", "a"),
            (11, "a b " * 250, "a"), (12, many + "\x0b\x0c\x1c", "a"), (-3, many, "b"), (13, "ÄÖÜ " * 201, "c"), (13, many, "c")]
    docs += [(100 + i, "a copy", "hot") for i in range(300)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (None, 1, 1), (8, 1, 1), (9, 0, 0), (150, 1, 1), (100, 1, 1), (77, 1, 1)]
    d = spark.createDataFrame([(i, t, s, "x", 3) for i, t, s in docs], "doc_id long, text string, source string, part string, mask int").repartition(4)
    e = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    assert got(audit.audit(d, e)) == brute(docs, labels)
    assert got(audit.audit(d, e.limit(0))) == brute(docs, [])
    assert got(audit.audit(d.limit(0), e)) == {}


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert got(queries.op13_audit(spark, SF)) == brute(docs, labels)


def test_ranks():
    orders, rank = audit.ranks(3)
    for o, order in enumerate(orders):
        for mask in range(8):
            assert rank[mask, o] == next((i for i, f in enumerate(order) if mask >> f & 1), 3)
    assert np.array_equal(rank[0], np.full(6, 3))
