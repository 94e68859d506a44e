"""Byte-level BPE encoding and decoding with segment trees.

A text is cut by the public pattern; each piece starts as its bytes.  A segment
tree over the byte positions holds at each leaf the rank of the pair that starts
there (the live symbol and its right live neighbour) and at each inner node the
smallest rank below it, the leftmost on ties.  A merge takes the root, joins the
two symbols, and makes three point updates (the merged symbol, its left neighbour,
the symbol that died), each logarithmic in the piece.

Two forms of the same tree: one piece at a time for long pieces, and for the many
short ones a whole batch of pieces of similar length at once, one tree per row of
a numpy array.  Pieces recur, so a worker keeps what it has encoded in a table of
at most ``MEMO_BYTES``; when it is full the older half goes, which changes
only speed.  Longer pieces than ``SHORT`` bytes are not kept.

Defined cases: null and empty texts have no ids; a piece that is itself a token is
that token; bytes that are no token are an error of the rank file (every single
byte must be one); ties in rank cannot occur between different pairs, equal pairs
merge leftmost first; extra columns are kept and columns named like the results
are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm.common import map_arrow, set_columns, slices, with_fields

MEMO_BYTES = 112 << 20  # of a worker's table: its characters, 8 bytes for each id and ENTRY bytes for each piece
ENTRY = 200  # bytes that a place in a dictionary, a string and a tuple take besides, about
SHORT = 64  # bytes; longer pieces get a tree of their own
NONE = (1 << 62)  # rank of "no pair here"
RESULT = (T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
          T.StructField("decoded_sha256", T.StringType()))


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank from a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder for one rank table and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        self.shared = {i: i for i in self.tokens}  # one int object per id, however often it is remembered
        self.decimal = {i: str(i) for i in self.tokens}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every way to split a token into two tokens: (left id, right id) -> merged id
        self.pairs = {(ranks[t[:k]], ranks[t[k:]]): i for t, i in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        keys = np.array([(a << 32) | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.int64((1 << 62) + 1))
        self.pair_ids = np.append(np.array(list(self.pairs.values()), np.int64)[order], NONE)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.memo_bytes = 0

    # one piece, one tree -------------------------------------------------
    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece by a segment tree of its own."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        size = 1 << max(0, (n - 1).bit_length())
        pairs, none = self.pairs, (NONE, 0)
        tree = [none] * (2 * size)  # (rank, position): the smallest is the leftmost minimum
        for i in range(n - 1):
            rank = pairs.get((ids[i], ids[i + 1]))
            if rank is not None:
                tree[size + i] = (rank, i)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int) -> None:
            j = right[i]
            rank = pairs.get((ids[i], ids[j])) if ids[i] >= 0 and j < n else None
            k = size + i
            tree[k] = none if rank is None else (rank, i)
            while k > 1:
                k >>= 1
                new = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == new:
                    break
                tree[k] = new

        while tree[1][0] != NONE:
            rank, i = tree[1]
            j = right[i]
            ids[i], ids[j] = rank, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            put(j)
            put(i)
            if left[i] >= 0:
                put(left[i])
        return tuple(x for x in ids if x >= 0)

    # many short pieces, one tree per row -----------------------------------
    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where it is not a token (or an id is missing)."""
        key = (a << 32) | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ids[at], NONE)

    def encode_rows(self, pieces: list[bytes], size: int) -> list[tuple[int, ...]]:
        """Ids of pieces of at most ``size`` bytes (a power of two): row r's tree is column r of ``tree``."""
        m = len(pieces)
        rows = np.arange(m)
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size).T
        ids = np.full((size + 1, m), -1, np.int64)  # row `size` stands for "no neighbour"
        ids[:size] = np.where(np.arange(size)[:, None] < lengths, self.byte_ids[raw], -1)
        right = np.repeat(np.arange(1, size + 1)[:, None], m, 1)
        left = np.repeat(np.arange(-1, size - 1)[:, None], m, 1)
        bits = size.bit_length()
        tree = np.full((2 * size, m), NONE, np.int64)  # rank << bits | position: the smallest is the leftmost minimum
        first = self.rank_of(ids[:size], ids[1:])
        tree[size:] = np.where(first == NONE, NONE, (first << bits) | np.arange(size)[:, None])
        for k in range(size - 1, 0, -1):
            tree[k] = np.minimum(tree[2 * k], tree[2 * k + 1])

        def put(r: np.ndarray, i: np.ndarray) -> None:
            j = right[i, r]
            rank = self.rank_of(ids[i, r], ids[j, r])
            k = size + i
            tree[k, r] = np.where(rank == NONE, NONE, (rank << bits) | i)
            while k[0] > 1:
                k = k >> 1
                tree[k, r] = np.minimum(tree[2 * k, r], tree[2 * k + 1, r])

        live = rows[tree[1] != NONE]
        while len(live):
            top = tree[1, live]
            i = top & ((1 << bits) - 1)
            j = right[i, live]
            after = right[j, live]
            ids[i, live], ids[j, live] = top >> bits, -1
            right[i, live] = after
            inner = after < size
            left[after[inner], live[inner]] = i[inner]
            put(live, j)
            put(live, i)
            before = left[i, live]
            has = before >= 0
            if has.any():
                put(live[has], before[has])
            live = live[tree[1, live] != NONE]
        flat = ids[:size].T
        kept = flat >= 0
        ends = np.cumsum(kept.sum(1)).tolist()
        values = list(map(self.shared.__getitem__, flat[kept].tolist()))
        return [tuple(values[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def code(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct pieces; those of short ones are remembered."""
        found, long, ranks = {}, {}, self.ranks
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode("utf-8", "replace")
            whole = ranks.get(raw)
            if whole is not None:
                (found if len(raw) <= SHORT else long)[p] = (self.shared[whole],)
            elif len(raw) > SHORT:
                long[p] = self.encode_piece(raw)
            else:
                by_size.setdefault(1 << max(2, (len(raw) - 1).bit_length()), []).append((p, raw))
        for size, group in by_size.items():
            step = max(1, (1 << 18) // size)
            for at in range(0, len(group), step):
                part = group[at:at + step]
                found |= zip([p for p, _ in part], self.encode_rows([raw for _, raw in part], size))
        self.remember(found)
        return found | long

    def remember(self, found: dict[str, tuple[int, ...]]) -> None:
        """Keep ids; the older half of the table goes as often as it is too large."""
        size = lambda p, ids: len(p) + 8 * len(ids) + ENTRY
        self.memo |= found
        self.memo_bytes += sum(map(size, found, found.values()))
        while self.memo_bytes > MEMO_BYTES:
            for p in list(islice(self.memo, (len(self.memo) + 1) // 2)):
                self.memo_bytes -= size(p, self.memo.pop(p))

    def encode_batch(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text."""
        get, findall = self.memo.get, self.pattern.findall
        cut = [findall(t) if t else [] for t in texts]
        known = [list(map(get, pieces)) for pieces in cut]
        new = {p for pieces, ids in zip(cut, known) if None in ids for p, i in zip(pieces, ids) if i is None}
        new = self.code(new) if new else new
        for pieces, ids in zip(cut, known):
            if None in ids:
                ids = [new[p] if i is None else i for p, i in zip(pieces, ids)]
            yield list(chain.from_iterable(ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, kept by the worker process between tasks."""
    if (path, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, rank_path: str, pattern: str, with_ids: bool = False, digests: bool = True) -> DataFrame:
    """``docs`` with n_tokens, digests of the ids and of the decoded bytes and, if asked for, the ids themselves."""
    fields = (*(RESULT if digests else RESULT[:1]),
              *((T.StructField("token_ids", T.ArrayType(T.IntegerType())),) if with_ids else ()))
    schema = with_fields(docs.schema, *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out = codec(rank_path, pattern), to_arrow_schema(schema)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                counts, sha, back, all_ids = [], [], [], []
                for ids in coder.encode_batch(batch.column("text").to_pylist()):
                    counts.append(len(ids))
                    if digests:
                        sha.append(hashlib.sha256(",".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest())
                        back.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                    if with_ids:
                        all_ids.append(np.array(ids, np.int32))
                new = {"n_tokens": pa.array(counts, pa.int64())}
                if digests:
                    new |= {"ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
                if with_ids:
                    new["token_ids"] = pa.array(all_ids, pa.list_(pa.int32()))
                yield set_columns(batch, out, **new)

    return map_arrow(docs, run, schema)
