"""Prefix trie against a plain statement of its nodes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from scrubline.llm import queries, trie

from .brute import words

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(turn):
    role, text = ((x or "").encode() for x in turn)
    return hashlib.sha256(len(role).to_bytes(8, "big") + role + text).hexdigest()[:32] + f"{len(words(turn[1])):08X}"


def brute(rows):
    """rows: (conv_id, turn, role, text) -> rows of COLUMNS, sorted"""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, digest((r, x)), (r or "", x or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, seq in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c > 0 else -1)
        full = tuple(own.get(base, [])[:h] + seq[h:])
        for d in range(len(full) + 1):
            members[full[:d]].add(c)
        ends[full].append(c)
    out = []
    for node, of in members.items():
        below = [n for n in members if n[:len(node)] == node]
        inner = {n[:-1] for n in members if n}
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
                    sum(len(n) == len(node) + 1 for n in below), sum(n not in inner for n in below),
                    sum((len(members[n]) - 1) * len(words(n[-1][1])) for n in below if n),
                    hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    return sorted(map(tuple, trie.nodes(df, **how).select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(0, 1, "user", "a b"), (0, 0, "user", "same first turn"), (0, 2, None, None), (0, 3, "x", "long " * 3000), (None, 1, "user", "nobody"),
            (7, None, "user", "same first turn"), (7, 1, "user", "a b"), (8, 0, "user", "same first turn"), (8, 0, "user", "same first turn"),
            (8, 0, "bot", "tie"), (9, 1, "", ""), (9, 2, None, ""), (-5, 1, "u", "a b c\x0bd"), (-20, 1, "u", "minus"), (40, 5, "u", "only"),
            (41, 1, "u", "y"), (60, 1, "ab", "c"), (61, 1, "a", "bc")]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(4)]  # copies of one conversation
    rows += [(c, t, "user", f"turn {t if t < 6 else t * c}") for c in range(200, 230) for t in range(9)]  # a long path in common
    rows += [(999, t, "user", f"step {t % 3}") for t in range(500)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "clash", 1) for c, t, r, x in rows],
                                 "conv_id long, turn long, role string, text string, skey string, depth int").repartition(5)


@pytest.mark.parametrize("container", [1, 60, 100_000])
def test_nodes(spark, odd, container):
    assert got(frame(spark, odd), container_turns=container) == brute(odd)


def test_chunked_digests(spark, odd, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    assert got(frame(spark, odd)) == brute(odd)


def test_empty(spark):
    assert got(frame(spark, [(1, 1, "u", "x")]).limit(0)) == []
    assert got(frame(spark, [(None, 1, "u", "x")])) == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op11_trie(spark, SF).select(*COLUMNS).collect()), key=str) == brute(rows)
