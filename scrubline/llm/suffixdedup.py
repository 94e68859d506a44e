"""Removal of repeated byte strings by prefix-free parsing.

Parse: a rolling hash runs over the bytes of each document; the places where it is
smallest within a stretch of ``STRETCH`` positions are triggers, and the text
between triggers is a phrase.  Every string of ``WIDTH`` bytes holds a trigger, chosen
by its own bytes, within its first ``STRETCH`` places, so equal strings are cut alike.

Order: a string is the suffix of a phrase (the bytes before its trigger) followed by
the start of a suffix of the parse (the bytes from its trigger on).  Parse suffixes
are bucketed by their first bytes; buckets of one member are done with, and equal
phrases in equal surroundings settle each other by hash (highly repetitive text ends
there).  For the other buckets two suffix arrays are made: of the dictionary (phrase
suffixes, sorted from the trigger backwards, with the lengths that neighbours share)
and of the parse (what follows the trigger, sorted, with common prefix lengths).
Together they give the order of the strings: by dictionary suffix, then by rank of
the parse suffix.  A string is repeated if it shares ``WIDTH`` bytes with a neighbour
in that order.  Buckets with more than ``HOT`` members are decided string by string
instead, so no bucket is held whole by one task beyond that.

Matches never cross documents; strings are judged on the input.  Hashes: two of 64
bits decide together that two stretches are equal.

Defined cases: null text is empty; a text shorter than the width loses nothing;
repeated rows remove each other's text entirely (from the width on); an empty table
gives no rows; extra columns are kept by ``dedup``.  Texts of any length are read in
bounded stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm import repeats
from scrubline.llm.common import map_arrow, materialize, set_columns, with_fields
from scrubline.llm.neardup import mix
from scrubline.llm.repeats import CHUNK, Prefix, Segments, runs

WIDTH = 200
GRAM = 8  # bytes under the rolling hash
STRETCH = 96  # a trigger at least every so many bytes
HOT = 1024  # open rows of one bucket that are ordered in one task
ORDER_ROWS = 20_000  # open rows ordered at a time
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW = (1 << 18) - 1


def values(raw: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(raw, np.uint8)]


def stretch_minima(g: np.ndarray, width: int) -> np.ndarray:
    """For each x the place of the smallest of g[x:x + width], the last one on ties."""
    low = np.uint64(_LOW)
    packed = (g & ~low) | (low - np.arange(len(g), dtype=np.uint64))
    span = 1
    while 2 * span <= width:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    if span < width:
        packed = np.minimum(packed[:span - width], packed[width - span:])
    return (low - (packed & low)).astype(np.int64)


def anchors(raw: bytes, width: int = WIDTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, ctx, trigger, first start, last start) for the strings of one document."""
    for base in range(0, len(raw) - width + 1, CHUNK):
        v = values(raw[base:base + CHUNK - 1 + width])
        prefix = Prefix(v)
        at = np.arange(len(v) - GRAM + 1)
        p = stretch_minima(prefix.spans(at, at + GRAM), STRETCH)[:len(v) - width + 1]
        lo, hi = runs(p)
        p = p[lo]
        key = prefix.spans(p, p + width - STRETCH + 1)
        ctx = mix(prefix.spans(lo, hi + width) + ((p - lo) << 8 | (p - hi)).astype(np.uint64))
        yield key, ctx, p + base, lo + base, hi + base


def columns_of(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian numbers, the least significant column first (for lexsort)."""
    wide = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(">u8").astype(np.uint64)
    return list(wide.T[::-1])


def shared(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Common prefix length of each row with the one before it in ``order`` (-1 for another key)."""
    a, b = rows[order[:-1]], rows[order[1:]]
    differ = a != b
    n = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    n = np.minimum(n, np.minimum(lengths[order[:-1]], lengths[order[1:]]))
    return np.concatenate([[-1], np.where(key[order[:-1]] == key[order[1:]], n, -1)])


def grid(items: list[bytes], width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    data = b"".join((x[::-1] if reverse else x).ljust(width, b"\0") for x in items)
    return np.frombuffer(data, np.uint8).reshape(-1, width), np.array([len(x) for x in items])


def corpus_order(key: np.ndarray, left: list[bytes], right: list[bytes], far: np.ndarray, near: np.ndarray,
                 width: int = WIDTH) -> np.ndarray:
    """repeated[i, n]: the string that starts n bytes before trigger i is repeated among the rows of its key.

    Row i stands for the starts near[i] .. far[i] bytes before its trigger; ``left`` are
    the bytes before it and ``right`` those from it on.
    """
    m = len(key)
    tails, tail_n = grid(left, STRETCH, reverse=True)
    heads, head_n = grid(right, width)
    # suffix array of the dictionary: phrase suffixes read backwards from the trigger
    dictionary = np.lexsort([*columns_of(tails), key])
    common_tail = shared(tails, tail_n, dictionary, key)
    # suffix array of the parse: what follows the triggers
    parse = np.lexsort([*columns_of(heads), key])
    rank = np.empty(m, np.int64)
    rank[parse] = np.arange(m)
    lcp = [shared(heads, head_n, parse, key)]  # lcp[j][r]: least common prefix over ranks r - 2^j + 1 .. r
    while 1 << len(lcp) <= m:
        step, low = 1 << (len(lcp) - 1), lcp[-1].copy()
        low[step:] = np.minimum(low[step:], lcp[-1][:-step])
        lcp.append(low)
    lcp = np.array(lcp)
    repeated = np.zeros((m, STRETCH), bool)
    for n in range(int(near.min()), int(far.max()) + 1):
        same = np.empty(m, np.int64)  # rows with the same phrase suffix of n bytes have the same number
        same[dictionary] = np.cumsum(common_tail < n)
        rows = np.flatnonzero((near <= n) & (n <= far))
        rows = rows[np.argsort(same[rows] * m + rank[rows])]  # corpus order: dictionary suffix, then parse suffix
        a, b = rows[:-1], rows[1:]
        length = rank[b] - rank[a]
        ok = (same[a] == same[b]) & (length > 0)
        a, b, length = a[ok], b[ok], length[ok]
        level = np.frexp(length.astype(np.float64))[1] - 1
        least = np.minimum(lcp[level, rank[b]], lcp[level, rank[a] + (1 << level)])
        hit = least >= width - n
        repeated[a[hit], n] = True
        repeated[b[hit], n] = True
    return repeated


def context_rows(seg: Segments, probes: DataFrame) -> DataFrame:
    """Open rows with the bytes around their triggers."""
    read = seg.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in repeats.side_by_side(batches, read, ["key", "pos"]):
            keys, locs, places, left, right = [], [], [], [], []
            for i, loc, (key, pos) in found:
                raw = b.column("text")[i].as_buffer()
                for k, at in zip(key[pos >= 0].astype(np.int64).tolist(), pos[pos >= 0].tolist()):
                    p = at >> 16
                    keys.append(k)
                    locs.append(loc)
                    places.append(at)
                    left.append(raw[max(0, p - STRETCH + 1):p].to_pybytes())
                    right.append(raw[p:p + WIDTH].to_pybytes())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(locs, pa.int64()), pa.array(places, pa.int64()),
                                                  pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                                                 names=["key", "loc", "pos", "left", "right"])

    return map_arrow(seg.by_part(probes.select("loc", "pos", "key")), run,
                     "key long, loc long, pos long, left binary, right binary")


def by_order(seg: Segments, probes: DataFrame) -> DataFrame:
    """(loc, pos) of the repeated strings among open rows, from the order of their buckets."""
    def decide(t: pa.Table) -> pa.RecordBatch:
        key, loc, pos = (t.column(c).to_numpy() for c in ("key", "loc", "pos"))
        far, near = (pos >> 8) & 255, pos & 255
        hit = corpus_order(key, t.column("left").to_pylist(), t.column("right").to_pylist(), far, near)
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)  # row-major: the ends come in the order of the starts
        return pa.RecordBatch.from_arrays([pa.array(loc[row]), pa.array((pos[row] >> 16 << 16) | ((last - 1) << 8) | first)],
                                          names=["loc", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= ORDER_ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                key = t.column("key").to_numpy()
                end = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
                if end:
                    yield decide(t.slice(0, end).combine_chunks())
                held = t.slice(end).combine_chunks().to_batches()
        if held and sum(x.num_rows for x in held):
            yield decide(pa.Table.from_batches(held).combine_chunks())

    rows = context_rows(seg, probes).repartition("key").sortWithinPartitions("key")
    return materialize(map_arrow(rows, run, "loc long, pos long"), "pfp-ordered")


def repeated_strings(seg: Segments) -> DataFrame:
    """(loc, pos) rows that stand for all repeated strings of the copied table."""
    rows = repeats.anchor_rows(seg, anchors, "pfp-anchors")
    found = repeats.judged(rows, "pfp-judged")
    flags = repeats.settled(rows).unionByName(found.filter("full").select("loc", "pos"), allowMissingColumns=True)
    flags = flags.unionByName(by_order(seg, found.filter(f"probe and open <= {HOT}")), allowMissingColumns=True)
    hot = found.filter(f"probe and open > {HOT}")
    if not hot.isEmpty():
        flags = flags.unionByName(repeats.by_window(seg, hot, values, WIDTH, "pfp-hot"), allowMissingColumns=True)
    return flags


RESULT = (T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()))


def kept_bytes(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _each(b: pa.RecordBatch, gone: dict) -> Iterator[tuple[bytes, bytes, int]]:
    for i, text in enumerate(b.column("text")):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        yield raw, kept_bytes(raw, *gone[i]) if i in gone else raw, len(gone[i][0]) if i in gone else 0


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    seg = Segments(docs.select("doc_id", "text"), "pfp-docs")
    schema = with_fields(docs.select("doc_id").schema, *RESULT)

    def build(b: pa.RecordBatch, gone: dict) -> pa.RecordBatch:
        rows = [(len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()) for raw, kept, n in _each(b, gone)]
        new = {f.name: pa.array(list(x), k) for f, x, k in zip(RESULT, zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))}
        return set_columns(b, to_arrow_schema(schema), **new)

    return repeats.finish(seg, repeated_strings(seg), WIDTH, schema, build)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text``.

    Bytes of a character that is cut through go with the string beside them; null text stays null.
    """
    seg = Segments(docs, "pfp-docs")
    schema = docs.schema

    def build(b: pa.RecordBatch, gone: dict) -> pa.RecordBatch:
        texts = [None if not t.is_valid else kept.decode("utf-8", "ignore")
                 for t, (_, kept, _) in zip(b.column("text"), _each(b, gone))]
        return set_columns(b, to_arrow_schema(schema), text=pa.array(texts, pa.string()))

    return repeats.finish(seg, repeated_strings(seg), WIDTH, schema, build)
