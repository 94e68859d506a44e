"""Removal of repeated word windows by recompression.

Rounds: a document starts as the 64-bit names of its words.  In each round the
boundary between two neighbouring symbols goes if both are equal (a run) or if the
left one tosses 0 and the right one 1 (a pair; the toss is a bit of the name and
differs from round to round); what is joined gets a new name from its parts.  Names
are hashes of what they stand for, so the same run or pair has the same name in
every document, task and job without a table of names.  A decision about a boundary
looks at its two neighbours only, so each boundary carries the stretch of words that
it depends on, and equal texts have equal symbols wherever that stretch is inside.

Reveal: a window of ``WIDTH`` words is represented by one boundary of a high round
whose stretch lies inside the window (of several, that with the smallest hash of its
two symbols); windows without one (rare) use a lower round or stand for themselves.
Its symbols and their stretch are the key: equal windows share it, and a key that
occurs once rules out all windows that it represents.

Verify: keys with several occurrences are compared by the hash of all their windows
together and, where these differ, window by window (see ``repeats``).

Defined cases: words are kept as they are; null, empty and short texts lose nothing;
repeated rows remove each other (from ``WIDTH`` words on); an empty table gives no
rows; extra columns are kept by ``dedup``.  Documents of any length are read in
bounded stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm import repeats
from scrubline.llm.common import set_columns, with_fields
from scrubline.llm.neardup import mix
from scrubline.llm.repeats import CHUNK, Prefix, Segments, runs

WIDTH = 35
ROUNDS = (4, 2)  # the rounds whose boundaries represent windows, best first
_FAR = 1 << 40
_INDEX = np.uint64((1 << 20) - 1)


def values(raw: bytes) -> np.ndarray:
    """Names of the words of a text in UTF-8."""
    words = raw.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def toss(names: np.ndarray, turn: int) -> np.ndarray:
    return (mix(names + np.uint64(turn + 1)) >> np.uint64(17)) & np.uint64(1)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A name for two symbols side by side."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right + np.uint64(0x632BE59BD9B4E019)))


def rounds(names: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """After each round 1..count the boundaries inside the text: (place, first and end of the stretch
    that they depend on, name of the two symbols that they kept apart)."""
    at = np.arange(len(names) + 1)
    first, end, out = at.copy(), at.copy(), []
    for turn in range(count):
        left, right = names[:-1], names[1:]
        coin = toss(names, turn)
        stays = np.flatnonzero(~((left == right) | ((coin[:-1] == 0) & (coin[1:] == 1)))) + 1
        # a boundary depends on its two symbols, so on all that decided their other ends; the ends of
        # the text depend on what no window sees
        stay_first, stay_end = first[stays - 1], end[stays + 1]
        out.append((at[stays], stay_first, stay_end, joined(left[stays - 1], right[stays - 1])))
        blocks = np.concatenate([[0], stays, [len(names)]])
        head = names[blocks[:-1]]
        same = np.add.reduceat((names == np.repeat(head, np.diff(blocks))).astype(np.int64), blocks[:-1])
        tail = np.diff(blocks) - same  # a block is a run, or a run followed by another
        renamed = mix(joined(mix(head + same.astype(np.uint64)), names[blocks[1:] - 1] + tail.astype(np.uint64)))
        names = np.where(np.diff(blocks) > 1, renamed, head)
        at = at[blocks]
        first = np.concatenate([[-_FAR], stay_first, [-_FAR]])
        end = np.concatenate([[_FAR], stay_end, [_FAR]])
        if len(names) < 2:
            break
    return out


def anchors(raw: bytes, width: int = WIDTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, ctx, anchor, first start, last start) for the windows of one document."""
    all_names = values(raw)
    for base in range(0, len(all_names) - width + 1, CHUNK):
        names = all_names[base:base + CHUNK - 1 + width]
        prefix, n = Prefix(names), len(names) - width + 1
        x = np.arange(n)
        place, key = x.copy(), np.zeros(n, np.uint64)  # a window without a boundary stands for itself
        found = np.zeros(n, np.int64)
        levels = rounds(names, max(ROUNDS))
        for number in ROUNDS:
            if number > len(levels):
                continue
            at, first, end, name = levels[number - 1]
            if not len(at):
                continue
            lo, hi = np.searchsorted(first, x), np.searchsorted(end, x + width, "right")
            todo = np.flatnonzero((hi > lo) & (found == 0))
            if not len(todo):
                continue
            low = [(mix(name) & ~_INDEX) | np.arange(len(at), dtype=np.uint64)]  # low[j][i]: smallest of i .. i + 2^j - 1
            while 2 << (len(low) - 1) <= width:
                step = 1 << (len(low) - 1)
                low.append(np.minimum(low[-1], np.append(low[-1][step:], np.full(min(step, len(at)), ~np.uint64(0)))[:len(at)]))
            low = np.array(low)
            a, b = lo[todo], hi[todo]
            level = np.frexp((b - a).astype(np.float64))[1] - 1
            best = (np.minimum(low[level, a], low[level, b - (1 << level)]) & _INDEX).astype(np.int64)
            place[todo], found[todo] = at[best], number
            key[todo] = joined(prefix.spans(first[best], end[best]), name[best]) + (at[best] - first[best]).astype(np.uint64)
        alone = found == 0
        key[alone] = mix(prefix.spans(x[alone], x[alone] + width))
        lo, hi = runs(place * 8 + found)
        p, kind = place[lo], found[lo].astype(np.uint64)
        ctx = mix(prefix.spans(lo, hi + width) + ((p - lo) << 8 | (p - hi)).astype(np.uint64) + (kind << np.uint64(40)))
        yield mix(key[lo] + kind), ctx, p + base, lo + base, hi + base


def repeated_windows(seg: Segments) -> DataFrame:
    """(loc, pos) rows that stand for all repeated windows of the copied table."""
    rows = repeats.anchor_rows(seg, anchors, "rec-anchors")
    found = repeats.judged(rows, "rec-judged")
    open_rows = repeats.by_window(seg, found.filter("probe"), values, WIDTH, "rec-windows")
    flags = found.filter("full").select("loc", "pos").unionByName(open_rows, allowMissingColumns=True)
    return repeats.settled(rows).unionByName(flags, allowMissingColumns=True)


RESULT = (T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("kept_sha256", T.StringType()))


def _each(b: pa.RecordBatch, gone: dict) -> Iterator[tuple[int, list[bytes]]]:
    for i, text in enumerate(b.column("text")):
        words = text.as_buffer().to_pybytes().split() if text.is_valid else []
        n = len(words)
        if i in gone:
            edges = [0, *np.stack(gone[i], 1).ravel().tolist(), n]
            words = [w for a, z in zip(edges[::2], edges[1::2]) for w in words[a:z]]
        yield n, words


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    seg = Segments(docs.select("doc_id", "text"), "rec-docs")
    schema = with_fields(docs.select("doc_id").schema, *RESULT)

    def build(b: pa.RecordBatch, gone: dict) -> pa.RecordBatch:
        rows = [(n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()) for n, kept in _each(b, gone)]
        new = {f.name: pa.array(list(x), k) for f, x, k in zip(RESULT, zip(*rows), (pa.int64(), pa.int64(), pa.string()))}
        return set_columns(b, to_arrow_schema(schema), **new)

    return repeats.finish(seg, repeated_windows(seg), WIDTH, schema, build)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows taken out; texts that lose words are joined by one blank, others stay as they are."""
    seg = Segments(docs, "rec-docs")
    schema = docs.schema

    def build(b: pa.RecordBatch, gone: dict) -> pa.RecordBatch:
        texts = [b" ".join(kept).decode("utf-8", "replace") if i in gone else t.as_py()
                 for i, (t, (_, kept)) in enumerate(zip(b.column("text"), _each(b, gone)))]
        return set_columns(b, to_arrow_schema(schema), text=pa.array(texts, pa.string()))

    return repeats.finish(seg, repeated_windows(seg), WIDTH, schema, build)
