"""Filter interaction audit with min-plus removal ranks.

``measure`` reads every text once and keeps a narrow row: the failures of the filters that
look at one text as bits, and a SHA-256 of the text.  The filter on copies needs the whole
table: the smallest id of each digest is a pre-aggregated minimum, and rows find out
whether they hold it by a join on (digest, id), a key that no group of copies makes hot.
What is left of the corpus is one count per part, mask of failures and label pair.

``ranks`` then says at which step an order of the filters removes a mask.  With M[m, f] = 0
where mask m fails filter f and infinity elsewhere, and P[f, o] the step at which order o
applies f (the inverse of the permutation), the removal step is the min-plus product
R[m, o] = min over f of M[m, f] + P[f, o].  A part's counts are scattered into (order, step) by R:
removed, kept and label losses are sums over the masks with R = step, and a mask that
fails the filter of a later step than R is redundant there.

Defined cases: a null text is empty, and so a copy of every empty text with a smaller id;
a null id is smaller than no id and larger than none, so its row never fails the filter on
copies and has no labels; rows that repeat a doc_id are counted each and are no smaller than one another;
labels of a doc_id in several rows hold if any row says so, null labels never; a null
source is the part of the empty string; texts of any length are measured whole; a table without rows gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import map_arrow, materialize, slices

MIN_WORDS = 200
MIN_DISTINCT_SHARE = 50  # per cent of the words
MAX_UPPER_SHARE = 2      # per cent of the code points
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no code point
#: The filters by bit; the last one looks for copies in the whole table.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_mask(text: bytes) -> int:
    """Failure bits of the filters that look at one text."""
    words = text.split()  # bytes are cut at \x20 and \x09-\x0D, no others
    points = len(text.translate(None, CONTINUATION))
    return ((len(words) < MIN_WORDS)
            | (100 * len(set(words)) < MIN_DISTINCT_SHARE * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, UPPER))) > MAX_UPPER_SHARE * points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every document."""
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), b.column("part"),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.array([text_mask(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])

    return map_arrow(rows, run, f"doc_id {kind}, part string, digest binary, mask int")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of each part fail exactly the filters of a mask."""
    seen = materialize(measure(docs), "audit-rows")
    units = seen.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    first = (seen.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    named = units.filter(F.col("doc_id").isNotNull()).join(first, ["digest", "doc_id"], "left")
    named = named.select("doc_id", "part", "n", F.when(F.col("first"), F.col("mask")).otherwise(
        F.col("mask").bitwiseOR(F.lit(COPY))).alias("mask"))
    told = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    named = named.join(told, "doc_id", "left").select("part", "mask", "n", "good", "toxic")
    nameless = (units.filter(F.col("doc_id").isNull())
                .select("part", "mask", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return (named.unionByName(nameless).select("part", "mask", flag("good"), flag("toxic"), "n")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def ranks(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of the filters, and R[mask, order]: the step (from 0) that removes the mask, ``n_filters`` for never."""
    orders = list(permutations(range(n_filters)))
    place = np.argsort(np.array(orders), axis=1).T  # [filter, order]: the inverse permutation
    fails = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    cost = np.where(fails == 1, 0, n_filters)  # n_filters stands for infinity
    return orders, np.minimum((cost[:, :, None] + place[None]).min(axis=1), n_filters)


def part_table(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of COUNTS as [order, step] arrays, from documents, good and toxic ones by mask."""
    n = len(counts).bit_length() - 1
    orders, rank = ranks(n)
    order_no = np.broadcast_to(np.arange(len(orders)), rank.shape)

    def scattered(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(orders), n + 1), np.int64)
        np.add.at(out, (order_no, rank), np.broadcast_to(weight[:, None], rank.shape))
        return out[:, :n]

    filters = np.array(orders)
    fails = (np.arange(len(counts))[:, None] >> np.arange(n)) & 1
    removed = scattered(counts)
    total = np.zeros(n, np.int64)
    np.add.at(total, filters, removed)
    return {"kept": counts.sum() - np.cumsum(removed, axis=1), "removed": removed,
            "redundant": (fails * counts[:, None]).sum(axis=0)[filters] - removed,
            "unique_fails": counts[1 << np.arange(n)][filters], "good_lost": scattered(good),
            "toxic_lost": scattered(toxic), "shapley": total[filters]}


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    names = ["".join(FILTERS[f] for f in order) for order in permutations(range(len(FILTERS)))]
    steps = np.arange(1, len(FILTERS) + 1)

    def of_part(key: tuple, rows: pa.Table) -> pa.Table:  # four rows per mask at most
        mask, n = rows.column("mask").to_numpy(), rows.column("n").to_numpy()
        def by_mask(keep: np.ndarray) -> np.ndarray:
            out = np.zeros(1 << len(FILTERS), np.int64)
            np.add.at(out, mask[keep], n[keep])
            return out

        good, toxic = (np.array(rows.column(c).to_pylist(), bool) for c in ("good", "toxic"))
        found = part_table(by_mask(np.ones(len(mask), bool)), by_mask(good), by_mask(toxic))
        return pa.table({"part": pa.array([key[0].as_py()] * (len(names) * len(steps)), pa.string()),
                         "filter_order": np.repeat(names, len(steps)), "step": pa.array(np.tile(steps, len(names)), pa.int32()),
                         **{c: found[c].ravel() for c in COUNTS}})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return failure_counts(docs, labels).groupBy("part").applyInArrow(of_part, schema)
