"""Repeated windows of a corpus, exactly: what prefix-free parsing and recompression share.

A document is a sequence of 64-bit values (bytes or words).  A window is ``width``
consecutive values of one document; a window is repeated if its values start
anywhere else too.  Both operators choose for every window start x an anchor p(x)
that depends on nothing but the window's own values, so equal windows have their
anchors at the same place.  Starts with one anchor are a contiguous range, and one
row per anchor stands for all of them:

* ``key``: hash of values around the anchor that all its windows hold.  Windows
  whose key occurs once cannot be repeated; most rows end here.
* ``ctx``: hash of the whole range.  A ctx that occurs twice settles all its windows.
* what is left (a key with several different contexts) is looked at window by window.

Rows meet by key in one shuffle; whether a row is settled shows in its neighbours
in (key, ctx) order.  Equal contexts of one stretch of text are settled before it: one
row goes on and the places of the others stay behind in the written table, so a passage
that stands in a large share of all documents shuffles a row per stretch of a few MB,
not per document.

Documents are copied once to the shared folder; rows name a copied file (part), a
row in it and a position, so texts are never shuffled: later steps hand each file's
rows to one task, which streams the file beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrubline.llm.common import map_arrow, materialize, open_fs, slices
from scrubline.llm.neardup import mix
from scrubline.session import new_run_dir

CHUNK = 200_000  # window starts looked at together; longer documents are cut, with overlap
ROW_BITS = 40  # loc = part << 40 | row
# pos = anchor << 16 | (anchor - lo) << 8 | (anchor - hi); more: (loc, pos) pairs of the same context in the same file
ANCHORS = "key long, ctx long, loc long, pos long, more binary"
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64, kept by the worker."""
    if base not in _POWERS or len(_POWERS[base]) <= n:
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        _POWERS[base] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[base]


class Prefix:
    """Hashes of any span of a sequence from one pass over it."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_BASE, n)[:n], out=self.sums[1:])
        self.inverse = powers(pow(_BASE, -1, 1 << 64), n)

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """A hash of values[lo:hi] for each pair; equal spans have equal hashes wherever they stand."""
        return mix((self.sums[hi] - self.sums[lo]) * self.inverse[lo] + (hi - lo).astype(np.uint64))


def runs(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal neighbours."""
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    return first, np.append(first[1:], len(p)) - 1


class Segments:
    """The copy of a table in the shared folder, read by file in tasks."""

    def __init__(self, docs: DataFrame, name: str):
        self.spark: SparkSession = docs.sparkSession
        self.path, self.schema = new_run_dir(self.spark, name), docs.schema
        docs.write.option("compression", "zstd").parquet(self.path)
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
        self.rows = (self.spark.read.schema(self.schema).parquet(self.path)
                     .select("text", (F.shiftleft(part, ROW_BITS).bitwiseOR(F.col("_metadata.row_index"))).alias("loc")))
        fs, root = open_fs(self.path)
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith("part-")]
        self.parts = [int(n.split("-")[1]) for n in names]
        # part-<number>-<what all files of one write share>: tasks make a file's name from its number
        self.suffix = names[0].split("-", 2)[2] if names else ""
        if any(n.split("-", 2)[2] != self.suffix for n in names):
            raise ValueError(f"files of several writes in {self.path}")

    def by_part(self, rows: DataFrame) -> DataFrame:
        """Rows (loc, pos, ...) in order, each file's rows in one task; every file has a row with pos = -1 besides."""
        n = max(self.parts, default=0) + 1  # one number per copied file
        marks = self.spark.createDataFrame([(p << ROW_BITS, -1) for p in self.parts], "loc long, pos long")
        each = rows.unionByName(marks, allowMissingColumns=True).withColumn("part", F.shiftright("loc", ROW_BITS).cast("int"))
        return each.repartitionById(n, "part").drop("part").sortWithinPartitions("loc")

    def reader(self) -> Callable[[int], Iterator[pa.RecordBatch]]:
        path, suffix = self.path, self.suffix

        def read(part: int) -> Iterator[pa.RecordBatch]:
            fs, root = open_fs(path)
            with fs.open_input_file(f"{root}/part-{part:05d}-{suffix}") as f:
                for b in pq.ParquetFile(f).iter_batches(batch_size=512):
                    yield from slices(b, "text")

        return read


def side_by_side(batches: Iterator[pa.RecordBatch], read: Callable, columns: list[str]):
    """Stream a file beside its rows: yields each batch of the file with, per document that has
    rows, (index in the batch, loc, arrays of the columns).

    The rows of one file are held together; they are fewer bytes than its text.  With the
    column ``more`` the places in it become rows of their own (then the only other column is ``pos``).
    """
    held, more = [], []
    for b in batches:
        held.append([b.column(c).to_numpy(zero_copy_only=False) for c in ["loc", *columns]])
        if "more" in b.schema.names:
            more += [np.frombuffer(x, np.int64) for x in b.column("more").drop_null().to_pylist()]
    if not sum(len(x[0]) for x in held):
        return
    data = [np.concatenate(x) for x in zip(*held)]
    if more:
        extra = np.concatenate(more).reshape(-1, 2).T
        data = [np.concatenate([d, x]) for d, x in zip(data, extra)]
    order = np.argsort(data[0], kind="stable")
    loc, *data = (d[order] for d in data)
    part = int(loc[0]) >> ROW_BITS
    start = part << ROW_BITS
    for b in read(part):
        at, end = np.searchsorted(loc, [start, start + b.num_rows])
        found = []
        if end > at:
            for i, j in zip(*runs(loc[at:end])):
                found.append((int(loc[at + i]) - start, int(loc[at + i]), [d[at + i:at + j + 1] for d in data]))
        yield b, found
        start += b.num_rows


def settle(key: np.ndarray, ctx: np.ndarray, loc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """One row per (file, key, ctx); a row that stands for several has the places of the others in ``more``."""
    part = loc >> ROW_BITS
    order = np.lexsort((ctx, key, part))
    key, ctx, loc, pos, part = (x[order] for x in (key, ctx, loc, pos, part))
    new = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    count = np.diff(np.append(first, len(key)))
    more: list[bytes | None] = [None] * len(first)
    places = np.stack([loc, pos], 1)
    for i in np.flatnonzero(count > 1).tolist():
        more[i] = places[first[i] + 1:first[i] + count[i]].tobytes()
    return pa.RecordBatch.from_arrays([*(pa.array(x[first]) for x in (key, ctx, loc, pos)), pa.array(more, pa.binary())],
                                      names=["key", "ctx", "loc", "pos", "more"])


def anchor_rows(seg: Segments, anchors: Callable[[bytes], Iterator[tuple[np.ndarray, ...]]], name: str) -> DataFrame:
    """A written table of the anchors of every document; ``anchors`` yields (key, ctx, anchor, lo, hi) arrays of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                found = []
                for text, loc in zip(b.column("text"), b.column("loc").to_pylist()):
                    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                    for key, ctx, p, lo, hi in anchors(raw):
                        pos = (p << 16) | ((p - lo) << 8) | (p - hi)
                        found.append((key.view(np.int64), ctx.view(np.int64), np.full(len(p), loc, np.int64), pos))
                if found:
                    yield settle(*(np.concatenate(x) for x in zip(*found)))

    return materialize(map_arrow(seg.rows, run, ANCHORS), name)


def settled(rows: DataFrame) -> DataFrame:
    """The places that were settled before the shuffle, as (loc, pos, more) rows (pos -1: none of its own)."""
    return rows.filter(F.col("more").isNotNull()).select("loc", F.lit(-1).cast("long").alias("pos"), "more")


def judged(rows: DataFrame, name: str) -> DataFrame:
    """Rows that are settled (``full``: all windows repeated) or open (``probe``), with the open rows of their key.

    In (key, ctx) order a row's neighbours tell: the same ctx beside it settles it (as does
    standing for several); a different ctx of the same key beside it makes it stand for
    its ctx among the open ones.
    """
    w = Window.partitionBy("key").orderBy("ctx")
    before, after = F.lag("ctx").over(w), F.lead("ctx").over(w)
    eq = lambda x: F.coalesce(x == F.col("ctx"), F.lit(False))
    ne = lambda x: F.coalesce(x != F.col("ctx"), F.lit(False))
    rows = rows.select("key", "ctx", "loc", "pos", F.col("more").isNotNull().alias("several")).repartition("key")
    out = (rows.withColumn("before", before).withColumn("after", after)
           .filter(F.col("before").isNotNull() | F.col("after").isNotNull() | F.col("several"))
           .select("key", "loc", "pos", (eq(F.col("before")) | eq(F.col("after")) | F.col("several")).alias("full"),
                   (ne(F.col("before")) | ne(F.col("after"))).alias("probe"))
           .withColumn("open", F.sum(F.col("probe").cast("int")).over(Window.partitionBy("key"))))
    return materialize(out.filter("full or probe"), name)


def open_windows(key: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, x) of every window of open rows."""
    p, far, near = pos >> 16, (pos >> 8) & 255, pos & 255
    count = far - near + 1
    x = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(p - far, count)
    return np.repeat(key, count), x


def by_window(seg: Segments, probes: DataFrame, values: Callable[[bytes], np.ndarray], width: int, name: str) -> DataFrame:
    """(loc, pos, more) of the repeated windows among all windows of open rows (loc, pos, key), by their hashes.

    Linear in the windows: a key with any number of open rows is spread over its windows, and
    equal windows of one stretch of a file are one row.
    """
    read = seg.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in side_by_side(batches, read, ["key", "pos"]):
            out = []
            for i, loc, (key, pos) in found:
                key, pos = key[pos >= 0].astype(np.int64), pos[pos >= 0]
                if not len(pos):
                    continue
                key, x = open_windows(key, pos)
                v = values(b.column("text")[i].as_buffer().to_pybytes())
                h = np.empty(len(x), np.uint64)
                for base in np.unique(x // CHUNK * CHUNK).tolist():  # long documents: a bounded stretch at a time
                    at = np.flatnonzero((x >= base) & (x < base + CHUNK))
                    h[at] = Prefix(v[base:base + CHUNK + width]).spans(x[at] - base, x[at] - base + width)
                out.append((key, h.view(np.int64), np.full(len(x), loc, np.int64), x << 16))
            if out:
                yield settle(*(np.concatenate(c) for c in zip(*out)))

    rows = materialize(map_arrow(seg.by_part(probes.select("loc", "pos", "key")), run, ANCHORS), name)
    n = F.count("*").over(Window.partitionBy("key", "ctx"))
    open_rows = rows.select("key", "ctx", "loc", "pos", F.col("more").isNotNull().alias("several")).withColumn("n", n)
    return settled(rows).unionByName(open_rows.filter("several or n > 1").select("loc", "pos"), allowMissingColumns=True)


def removed_runs(pos: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [lo, hi) of values covered by the windows that rows of one document stand for."""
    pos = pos[pos >= 0]
    lo, hi = (pos >> 16) - ((pos >> 8) & 255), (pos >> 16) - (pos & 255) + width
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    if not len(lo):
        return lo, hi
    first = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]


def finish(seg: Segments, flags: DataFrame, width: int, schema, build: Callable) -> DataFrame:
    """Stream every copied file beside its repeated windows; ``build`` makes the result rows of a batch.

    ``build(batch, {index: (lo, hi)})`` gets the removed runs of the documents that have any.
    """
    read = seg.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, found in side_by_side(batches, read, ["pos"]):
            gone = {i: removed_runs(pos, width) for i, _, (pos,) in found}
            yield build(b, {i: r for i, r in gone.items() if len(r[0])})

    return map_arrow(seg.by_part(flags.select("loc", "pos", "more")), run, schema)
