"""Exact top-k search by inner product with vector-approximation files.

Components become whole numbers floor(scale * x).  Equal vectors are one entry with the smallest
ids that hold it, so a vector that a third of all rows share is one entry.  Entries are written in
blocks as two parallel Arrow files per task: in the first, every component is a cell of ``2 ** BITS``
with the least and the greatest value of each cell in the block; in the second, the exact numbers.

The search runs over units of one block of queries and one range of entry blocks; a task maps the
files and carries the results of a query block from range to range, so no vector is shuffled.  For a block of entries the cells give an upper and a lower
bound of every inner product.  The (k + 1)-th largest lower bound, or the (k + 1)-th id so far,
is the threshold; entries whose upper bound reaches it are read exactly in order of their upper bound,
until no bound reaches the (k + 1)-th id by now (one more than k because a query
is no candidate of its own).  Tasks give at most k + 1 ids per query, which are merged.

All sums are whole numbers below 2**53 in doubles, so scores are exact.  Vectors with a larger
component than ``MAX_COMPONENT`` or more of them than ``MAX_DIM`` have no cells and meet the others in Python
integers; a score outside the range of a long becomes the nearest long.

Defined cases: rows with a null id, and vectors that are null or hold null or non-finite components
take no part; a zero vector does; queries meet vectors of their own length only; a vec_id in
several rows is one query with the least of its vectors (by their bytes), all its rows are candidates of others, and none
of its own; a query has all candidates if there are fewer than k; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.common import attempt_name, file_dir, map_arrow, materialize, open_fs

SCALE = 64
BITS = 4
BLOCK_ROWS = 8192      # entries of a block
BLOCK_CELLS = 1 << 21  # components of a block at most, one entry at least
QUERY_ROWS = 512      # queries of a block
RANGE_BLOCKS = 4       # blocks of entries that a unit searches
MAX_TASKS = 20_000
MAX_COMPONENT, MAX_DIM = 1 << 20, 1 << 12  # their products sum to less than 2**53
LONG = (-(1 << 63) + 1, (1 << 63) - 1)
ENTRY = "dim int, wide boolean, vector binary, ids array<struct<vec_id: long, n: long>>"
HITS = "qkey binary, score long, vec_id long, n long"


def packed(x: np.ndarray, scale: int) -> tuple[int, bool, bytes]:
    """(length, wide, bytes) of a vector of finite doubles as whole numbers: 32 bits each, or decimal text."""
    if len(x) <= MAX_DIM and (not len(x) or np.abs(x).max() * scale < MAX_COMPONENT):
        return len(x), False, np.floor(scale * x).astype("<i4").tobytes()
    return len(x), True, ",".join(str(int(np.floor(scale * v)) if np.isfinite(scale * v) else scale * int(v)) for v in x.tolist()).encode()


def whole(vector: bytes, wide: bool) -> list[int]:
    return [int(v) for v in vector.split(b",") if v] if wide else np.frombuffer(vector, "<i4").tolist()


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dim, wide, vector) of the rows that take part."""
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("embedding")
            flat = column.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
            ends = np.cumsum([0] + [len(v) for v in column])
            out = []
            for i, v in enumerate(b.column("vec_id").to_pylist()):
                x = flat[ends[i]:ends[i + 1]]
                if np.isfinite(x).all():
                    out.append((v, *packed(x, scale)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (
                pa.int64(), pa.int32(), pa.bool_(), pa.binary()))], names=["vec_id", "dim", "wide", "vector"])

    return map_arrow(rows, run, "vec_id long, dim int, wide boolean, vector binary")


def entries(rows: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector, with the ``ids`` smallest ids that hold it and in how many rows each does."""
    per_id = rows.groupBy("dim", "wide", "vector", "vec_id").agg(F.count("*").alias("n"))
    order = Window.partitionBy("dim", "wide", "vector").orderBy("vec_id")
    few = per_id.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= ids)  # cut in every task first
    return few.groupBy("dim", "wide", "vector").agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))


def cells_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a block with equally many entries per component, and the least and greatest value of each."""
    n, dim = x.shape
    levels = 1 << BITS
    marks = np.sort(x, axis=0)[(np.arange(1, levels) * n) // levels]
    cells = np.empty((n, dim), np.uint8)
    low, high = np.zeros((dim, levels)), np.zeros((dim, levels))
    for j in range(dim):
        c = cells[:, j] = np.searchsorted(marks[:, j], x[:, j], side="right")
        lo, hi = np.full(levels, np.inf), np.full(levels, -np.inf)
        np.minimum.at(lo, c, x[:, j])
        np.maximum.at(hi, c, x[:, j])
        low[j], high[j] = np.where(lo <= hi, lo, 0), np.where(lo <= hi, hi, 0)
    return cells, low, high


CELLS = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("wide", pa.bool_()), ("cells", pa.binary()), ("low", pa.binary()), ("high", pa.binary())])
EXACT = pa.schema([("vectors", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())])
ASKED = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("wide", pa.bool_()), ("vectors", pa.binary()), ("lengths", pa.binary()), ("keys", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, bool, list[bytes], list]]:
    """Runs of rows (dim, wide, vector, extra) with one length, at most ``rows`` and BLOCK_CELLS components each."""
    kind, vectors, extra = None, [], []
    for b in batches:
        for dim, wide, vector, x in zip(*(c.to_pylist() for c in b.columns)):
            if vectors and ((dim, wide) != kind or len(vectors) >= min(rows, max(1, BLOCK_CELLS // max(1, dim)))):
                yield *kind, vectors, extra
                vectors, extra = [], []
            kind = (dim, wide)
            vectors.append(vector)
            extra.append(x)
    if vectors:
        yield *kind, vectors, extra


def _lengths(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], "<i8").tobytes()


def _cut(data: bytes, lengths: bytes) -> list[bytes]:
    ends = np.cumsum(np.concatenate([[0], np.frombuffer(lengths, "<i8")]))
    return [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def write_blocks(df: DataFrame, folder: str, rows: int, is_query: bool) -> DataFrame:
    """Files of the blocks, one row (cells, exact, blocks) per task; query files have no cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = open_fs(folder)
        part = TaskContext.get().partitionId()
        names = [attempt_name("exact", part, ".arrow"), attempt_name("cells", part, ".arrow")]
        found = 0
        files = []
        for dim, wide, vectors, extra in _blocks(batches, rows):
            if not files:
                sinks = [fs.open_output_stream(f"{base}/{n}") for n in names[:1 if is_query else 2]]
                files = [pa.ipc.new_file(s, t) for s, t in zip(sinks, (ASKED if is_query else EXACT, CELLS))]
            data, lengths = b"".join(vectors), _lengths(vectors)
            if is_query:
                block = dict(dim=dim, n=len(vectors), wide=wide, vectors=data, lengths=lengths, keys=b"".join(extra))
            else:
                ids = [i for e in extra for i in e]
                block = dict(vectors=data, lengths=lengths, ids=np.array([i["vec_id"] for i in ids], "<i8").tobytes(),
                             counts=np.array([i["n"] for i in ids], "<i8").tobytes(),
                             places=np.cumsum([0] + [len(e) for e in extra]).astype("<i8").tobytes())
                cells = low = high = np.zeros(0)
                if not wide:
                    cells, low, high = cells_of(np.frombuffer(data, "<i4").reshape(len(vectors), dim).astype(np.float64))
                files[1].write_batch(pa.RecordBatch.from_pylist([dict(
                    dim=dim, n=len(vectors), wide=wide, cells=cells.tobytes(), low=low.tobytes(), high=high.tobytes())], CELLS))
            files[0].write_batch(pa.RecordBatch.from_pylist([block], ASKED if is_query else EXACT))
            found += 1
        for f, s in zip(files, sinks if files else []):
            f.close()
            s.close()
        if found:
            yield pa.RecordBatch.from_pylist([{"exact": names[0], "cells": names[1], "blocks": found}], pa.schema(
                [("exact", pa.string()), ("cells", pa.string()), ("blocks", pa.int64())]))

    return materialize(map_arrow(df, run, "exact string, cells string, blocks long"), "va-files")


class Best:
    """The best (score, vec_id, n) of a query so far, larger scores first, then smaller ids: all that can
    stand among the first k rows of other ids, whichever id is the query's own."""

    def __init__(self, k: int):
        self.k, self.rows, self.edge = k, [], -np.inf

    def add(self, rows: list[tuple[int, int, int]]) -> None:
        merged: dict[tuple[int, int], int] = {}
        for s, v, n in self.rows + rows:
            merged[s, v] = merged.get((s, v), 0) + n
        held: dict[int, int] = {}
        self.rows = []
        for (s, v), n in sorted(merged.items(), key=lambda r: (-r[0][0], r[0][1])):
            if held.get(v, 0) < self.k:  # no more than k rows of one id can count
                self.rows.append((s, v, n))
                held[v] = held.get(v, 0) + n
                if len(held) > self.k:  # k ids besides the query's own
                    self.edge = s
                    break


class Block:
    """A block of entries: bounds from its cells, exact numbers on demand."""

    def __init__(self, cells: dict, exact: dict):
        self.dim, self.n, self.wide, self.exact = cells["dim"], cells["n"], cells["wide"], exact
        self.places, self.ids, self.counts = (np.frombuffer(exact[c], "<i8") for c in ("places", "ids", "counts"))
        if not self.wide:
            at = np.frombuffer(cells["cells"], np.uint8).reshape(self.n, self.dim)
            j = np.arange(self.dim)
            self.low, self.high = (np.frombuffer(cells[c], np.float64).reshape(self.dim, 1 << BITS)[j, at].T for c in ("low", "high"))
            self.vectors = np.frombuffer(exact["vectors"], "<i4").reshape(self.n, self.dim)
            self.apart = len(np.unique(self.ids[self.places[:-1]])) == self.n  # no id with several vectors in the block

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ self.high + down @ self.low, up @ self.low + down @ self.high

    def rows(self, found: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, int]]:
        return [(int(s), int(self.ids[i]), int(self.counts[i])) for e, s in zip(found, scores)
                for i in range(self.places[e], self.places[e + 1])]

    def search(self, q: np.ndarray, best: list[Best]) -> None:
        """Let the entries of the block into the results of the queries q."""
        k = best[0].k + 1
        upper, lower = self.bounds(q)
        edge = np.array([b.edge for b in best])
        if self.apart and self.n > k and np.isneginf(edge).any():
            edge = np.maximum(edge, np.partition(lower, self.n - k, axis=1)[:, self.n - k])
        for i, b in enumerate(best):
            near = np.flatnonzero(upper[i] >= edge[i])
            if not len(near):
                continue
            near = near[np.argsort(-upper[i, near], kind="stable")]
            bound, step, at = upper[i, near], 2 * k, 0
            while at < len(near) and bound[at] >= b.edge:  # ties of the edge may hold smaller ids
                some = near[at:at + step]
                scores = self.vectors[some].astype(np.float64) @ q[i]
                good = scores >= b.edge
                if good.any():
                    b.add(self.rows(some[good], scores[good]))
                at, step = at + step, 2 * step

    def search_whole(self, queries: list[list[int]], best: list[Best]) -> None:
        """The same in Python integers, for numbers that doubles do not add exactly."""
        mine = [whole(v, self.wide) for v in _cut(self.exact["vectors"], self.exact["lengths"])]
        for q, b in zip(queries, best):
            for e, v in enumerate(mine):
                score = min(max(sum(x * y for x, y in zip(q, v)), LONG[0]), LONG[1])
                if score >= b.edge:
                    b.add(self.rows(np.array([e]), [score]))


def _row(reader: pa.RecordBatchFileReader, at: int) -> dict:
    """A block without copying its bytes."""
    b = reader.get_batch(at)
    return {n: memoryview(c[0].as_buffer()) if pa.types.is_binary(c.type) else c[0].as_py() for n, c in zip(b.schema.names, b.columns)}


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates for every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, scale), "va-rows")
    vector = F.struct("dim", "wide", "vector")
    asked = (rows.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(vector).alias("v"))
             .select("query_id", F.col("v.dim").alias("dim"), F.col("v.wide").alias("wide"), F.col("v.vector").alias("vector")))
    key = F.unhex(F.md5(F.concat(F.col("dim").cast("string").cast("binary"), F.lit(b":"), "vector")))
    asked = materialize(asked.withColumn("qkey", key), "va-asked")
    folder = file_dir(spark, "va")
    by_kind = ("dim", "wide")
    data = write_blocks(materialize(entries(rows, k + 1), "va-entries").sortWithinPartitions(*by_kind), folder, BLOCK_ROWS, False)
    query = write_blocks(materialize(asked.groupBy("dim", "wide", "vector").agg(F.first("qkey").alias("qkey")), "va-queries")
                         .sortWithinPartitions(*by_kind), folder, QUERY_ROWS, True)
    # one row per file, not per vector; files become ranges of blocks
    ranges = [(r.exact, r.cells, at, min(at + RANGE_BLOCKS, r.blocks)) for r in data.collect() for at in range(0, r.blocks, RANGE_BLOCKS)]
    blocks = [(r.exact, at) for r in query.collect() for at in range(r.blocks)]
    result = T._parse_datatype_string("query_id long, rank int, vec_id long, score long")
    if not (ranges and blocks):
        return spark.createDataFrame([], result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        held: dict[str, pa.RecordBatchFileReader] = {}

        def reader(name: str) -> pa.RecordBatchFileReader:
            if name not in held:
                if len(held) >= 8:
                    held.clear()
                held[name] = pa.ipc.open_file(fs.open_input_file(f"{base}/{name}"))
            return held[name]

        def row(keys: bytes, found: list[Best]) -> pa.RecordBatch:
            out = [(bytes(keys[16 * i:16 * i + 16]), *r) for i, b in enumerate(found) for r in b.rows]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (
                pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=["qkey", "score", "vec_id", "n"])

        last, q, best, numbers = None, None, [], None
        for b in batches:
            for unit in b.column(0).to_pylist():
                exact, cells, start, stop = ranges[unit % len(ranges)]
                if unit // len(ranges) != last:  # results are carried from range to range
                    if best:
                        yield row(q["keys"], best)
                    last = unit // len(ranges)
                    name, at = blocks[last]
                    q = _row(reader(name), at)
                    best = [Best(k) for _ in range(q["n"])]
                    numbers = None if q["wide"] else np.frombuffer(q["vectors"], "<i4").reshape(q["n"], q["dim"]).astype(np.float64)
                for i in range(start, stop):
                    c = _row(reader(cells), i)
                    if c["dim"] != q["dim"]:
                        continue
                    block = Block(c, _row(reader(exact), i))
                    if block.wide or numbers is None:
                        block.search_whole([whole(bytes(v), q["wide"]) for v in _cut(q["vectors"], q["lengths"])], best)
                        continue
                    for part in range(0, len(numbers), 128):
                        block.search(numbers[part:part + 128], best[part:part + 128])
        if best:
            yield row(q["keys"], best)

    n_units = len(ranges) * len(blocks)  # the ranges of a query block follow each other
    hits = map_arrow(spark.range(0, n_units, 1, min(n_units, MAX_TASKS)), run, HITS)
    # of each id its k best rows, then of each query the k + 1 ids with the best rows: k of them are others
    per_id = hits.groupBy("qkey", "vec_id").agg(F.max("score").alias("best"), F.slice(
        F.sort_array(F.collect_list(F.struct("score", "n")), asc=False), 1, k).alias("rows"))
    order = Window.partitionBy("qkey").orderBy(F.desc("best"), "vec_id")
    top = (per_id.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
           .groupBy("qkey").agg(F.flatten(F.collect_list(F.transform("rows", lambda r: F.struct(
               (-r["score"]).alias("neg"), F.col("vec_id"), r["n"].alias("n"))))).alias("hits")))
    return (asked.select("query_id", "qkey").join(top, "qkey")
            .select("query_id", F.expr(f"""posexplode(slice(flatten(transform(sort_array(filter(hits, h -> h.vec_id != query_id)),
                h -> array_repeat(named_struct('vec_id', h.vec_id, 'neg', h.neg), cast(least(h.n, {k}) as int)))), 1, {k}))""").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.neg")).alias("score")))
