"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first search.

Fit: a tree of centroids is grown by k-means on a bounded sample (``SAMPLE_ROWS``
rows, chosen by hash); leaves number about rows / ``LEAF_ROWS``, at most
``MAX_LEAVES``, so the tree that tasks carry is bounded by leaves x dimension.

Index: every row goes down the tree to its nearest leaf.  Leaves are cut into
chunks of about ``CHUNK_ROWS`` rows by a hash of the id, so a leaf that holds a
third of all rows (copies of one vector) is many chunks, never one task.

Search: a query walks the tree with a priority queue that holds the open branches
by inner product with their centroids, best first, and lists the first leaves that
it reaches.  How many leaves it visits is calibrated: a bounded set of sample
queries is searched by brute force over all rows, and visits widen until the mean
recall reaches ``TARGET_RECALL``.  Queries meet the chunks of their leaves in
blocks (a co-group by leaf, chunk and query block); each block gives its best k
per query, which are merged per query.

Scores are inner products of the original vectors in double precision, summed in
component order for every pair alike, so equal vectors have equal scores and ties
go to the smaller id.

Defined cases: rows with a null id, and vectors that are null, zero, of another
length than most, or with null or non-finite components take no part; a vec_id in
several rows is one query, all its rows are candidates of others, and none of its
own; a query has all candidates if there are fewer than k; an empty table gives no
rows.  Extra columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import map_arrow, materialize, ship_code

SAMPLE_ROWS = 20_000
LEAF_ROWS = 400
MAX_LEAVES = 4096
BRANCHING = 16
CHUNK_ROWS = 2048
QUERY_BLOCK = 1024
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.96
HITS = "query_id long, hits array<struct<neg: double, vec_id: long, leaf: int>>"


class Tree:
    """Centroids by node; a child is a node (its number) or a leaf (-1 - its number)."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 11):
        self.nodes: list[tuple[np.ndarray, list[int]]] = []
        self.n_leaves = 0
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.unique(sample, axis=0), leaves)

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        k = min(BRANCHING, leaves, len(x) // 2)
        if k < 2:
            self.n_leaves += 1
            return -self.n_leaves
        centers, label = self._kmeans(x, k)
        parts = [x[label == i] for i in range(len(centers))]
        keep = [i for i, p in enumerate(parts) if len(p)]
        number = len(self.nodes)
        self.nodes.append((centers[keep], []))
        if len(keep) < 2:
            self.nodes[number][1].append(-self.n_leaves - 1)
            self.n_leaves += 1
            return number
        self.nodes[number][1].extend(self._grow(parts[i], round(leaves * len(parts[i]) / len(x))) for i in keep)
        return number

    def _kmeans(self, x: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
        centers = x[self.rng.choice(len(x), k, replace=False)]
        for _ in range(rounds):
            label = nearest(x, centers)
            sums = np.zeros_like(centers)
            np.add.at(sums, label, x)
            counts = np.bincount(label, minlength=k)
            centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
        return centers, nearest(x, centers)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child all the way down."""
        out = np.zeros(len(x), np.int32)
        work = [(self.root, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            centers, children = self.nodes[node]
            label = nearest(x[rows], centers)
            work += [(c, rows[label == i]) for i, c in enumerate(children) if (label == i).any()]
        return out

    def leaves_of(self, q: np.ndarray, visits: int, rows: dict[int, int] | None = None, need: int = 0) -> list[int]:
        """Best-bin-first: the first ``visits`` leaves in order of the best open branch, and more
        until they hold ``need`` of the ``rows`` that each leaf has."""
        out, held, heap = [], 0, [(0.0, self.root)]
        while heap and (len(out) < visits or held < need):
            _, node = heapq.heappop(heap)
            if node < 0:
                out.append(-node - 1)
                held += rows.get(-node - 1, 0) if rows else 0
                continue
            centers, children = self.nodes[node]
            for score, child in zip((centers @ q).tolist(), children):
                heapq.heappush(heap, (-score, child))
        return out


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(1) - 2.0 * (x @ centers.T), axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, summed in component order: the same bits for the same pair in any block."""
    out = np.zeros((len(q), len(x)))
    held = np.empty_like(out)
    for d in range(q.shape[1]):
        np.multiply.outer(q[:, d], x[:, d], out=held)
        out += held
    return out


def best(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, leaf: np.ndarray, k: int) -> pa.Table:
    """The k best rows of a block for each query: larger product first, then smaller id."""
    rows, hits = [], []
    by_id = np.argsort(vid, kind="stable")
    vid, x, leaf = vid[by_id], x[by_id], leaf[by_id]
    for at in range(0, len(q), 128):
        s = products(q[at:at + 128], x)
        s[qid[at:at + 128, None] == vid[None, :]] = -np.inf
        for i, line in enumerate(s):
            if len(line) > k:
                edge = np.partition(line, len(line) - k)[len(line) - k]
                some = np.flatnonzero(line >= edge)  # in id order; ties at the edge stay in
            else:
                some = np.arange(len(line))
            some = some[np.argsort(-line[some], kind="stable")][:k]
            some = some[line[some] > -np.inf]
            rows.append(int(qid[at + i]))
            hits.append([{"neg": 0.0 - float(line[j]), "vec_id": int(vid[j]), "leaf": int(leaf[j])} for j in some])
    return pa.table({"query_id": pa.array(rows, pa.int64()), "hits": pa.array(hits, pa.list_(pa.struct(
        [("neg", pa.float64()), ("vec_id", pa.int64()), ("leaf", pa.int32())])))})


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .filter(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda v: v != 0)))
    sizes = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.filter(F.size("embedding") == (sizes["n"] if sizes else 0))


def merged(hits: DataFrame, k: int) -> DataFrame:
    """The k best of all blocks per query."""
    return (hits.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")))


def draw(column: str, seed: int) -> Column:
    """A number in [0, 1) from a hash of the row."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def calibrate(index: DataFrame, tree: Tree, queries: list, k: int, target: float) -> tuple[int, float]:
    """Leaf visits at which the calibration queries reach the target recall, and that recall."""
    qid = np.array([r["vec_id"] for r in queries], np.int64)
    q = np.array([r["embedding"] for r in queries], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = best(qid, q, b.column("vec_id").to_numpy(), matrix(b.column("embedding")), b.column("leaf").to_numpy(), k)
            yield from t.to_batches()

    truth = {r["query_id"]: [h["leaf"] for h in r["hits"]] for r in merged(map_arrow(index, run, HITS), k).collect()}
    places = []
    for i, v in zip(qid, q):
        order = {leaf: n + 1 for n, leaf in enumerate(tree.leaves_of(v, tree.n_leaves))}
        places += [order[leaf] for leaf in truth.get(int(i), [])]
    if not places:
        return tree.n_leaves, 1.0
    found = np.cumsum(np.bincount(places, minlength=tree.n_leaves + 1)) / len(places)
    visits = max(1, int(np.argmax(found >= target)))
    return visits, float(found[visits])


def search(vectors: DataFrame, is_query: Column, k: int = 20, target: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = materialize(usable(vectors), "ann-rows")
    count = rows.count()
    sample = (rows.filter(draw("vec_id", 1) < min(1.0, SAMPLE_ROWS / max(1, count))).limit(2 * SAMPLE_ROWS)
              .select("embedding").toArrow().column(0).combine_chunks())
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        if not count:
            return spark.createDataFrame([], schema)
        sample = rows.limit(1000).select("embedding").toArrow().column(0).combine_chunks()
    tree = Tree(matrix(sample), max(1, min(MAX_LEAVES, count // LEAF_ROWS)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.assign(matrix(b.column("embedding"))) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32())], names=["vec_id", "embedding", "leaf"])

    kind = dict(rows.dtypes)["embedding"]
    index = materialize(map_arrow(rows, place, f"vec_id long, embedding {kind}, leaf int"), "ann-index")
    trial = index.filter(draw("vec_id", 2) < min(1.0, CALIBRATION_QUERIES / count)).limit(2 * CALIBRATION_QUERIES).collect()
    visits, _ = calibrate(index, tree, trial or index.limit(50).collect(), k, target)

    held = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # at most MAX_LEAVES

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column("own").to_pylist()  # rows with the query's id are no candidates
            leaves = [tree.leaves_of(q, visits, held, k + n) for q, n in zip(matrix(b.column("query")), own)]
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("query"), pa.array(leaves, pa.list_(pa.int32()))],
                                             names=["query_id", "query", "leaves"])

    asked = (index.filter(is_query).groupBy(F.col("vec_id").alias("query_id"))
             .agg(F.first("embedding").alias("query"), F.count("*").alias("own")))
    asked = materialize(map_arrow(asked, route, f"query_id long, query {kind}, leaves array<int>"), "ann-queries")

    # one row per leaf: into how many chunks and query blocks it is cut
    sizes = (index.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks"))
             .join(asked.select(F.explode("leaves").alias("leaf")).groupBy("leaf")
                   .agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks")), "leaf"))
    sizes = F.broadcast(materialize(sizes, "ann-leaves"))  # at most MAX_LEAVES rows
    salt = lambda c, n: F.pmod(F.xxhash64(F.lit(3), F.col(c)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (index.join(sizes, "leaf").withColumn("chunk", salt("vec_id", "chunks")).withColumn("block", each("blocks"))
            .select("leaf", "chunk", "block", "vec_id", "embedding"))
    right = (asked.withColumn("leaf", F.explode("leaves")).join(sizes, "leaf")
             .withColumn("block", salt("query_id", "blocks")).withColumn("chunk", each("chunks"))
             .select("leaf", "chunk", "block", "query_id", "query"))

    def meet(x: pa.Table, q: pa.Table) -> pa.Table:
        x, q = x.combine_chunks(), q.combine_chunks()
        column = lambda t, c: t.column(c).combine_chunks()
        if not (x.num_rows and q.num_rows):
            return best(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int32), k)
        return best(column(q, "query_id").to_numpy(), matrix(column(q, "query")), column(x, "vec_id").to_numpy(),
                    matrix(column(x, "embedding")), column(x, "leaf").to_numpy(), k)

    key = ["leaf", "chunk", "block"]
    hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, HITS)
    return (merged(hits, k).select("query_id", F.posexplode("hits").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (F.lit(0.0) - F.col("hit.neg")).alias("score")))
