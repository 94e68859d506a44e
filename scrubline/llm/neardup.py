"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its 5-word shingles (fewer words: the whole sequence).

Sketch: rounds of hashed bin placement.  In each of the first t rounds every
element falls into one of t bins by a hash of its own; in round t + i all fall
into bin i.  A bin keeps the smallest (round, hash) that fell into it, so after at
most 2t rounds every coordinate is filled, usually after one or two; two sets agree
in a coordinate with probability equal to their Jaccard similarity, and the number
of agreements is concentrated like that of independent coordinates.

Candidates: classes of documents with the same set are one node.  Bands of the
sketch are buckets.  In each bucket all members are verified against one centre
(the member that shares most buckets with others), which is linear in the bucket;
the links found give components.  What can still be missed are links between
different components of one bucket: for members outside the bucket's largest
component all partners are looked at in blocks inside a task that hold their full sets, and a pair is
verified there unless something rules it out: that other links of the block join its components, the
sizes, the triangle inequality of the Jaccard distance over the centre (all exact), or the
sketches (so few agreements that a pair at the threshold has them with probability
below ``MISS``).  A block gives no more links than it has members.  No bucket is capped.

Verification: intersections of full sets of 64-bit shingle hashes.

``BANDS`` follow from the threshold: a pair at the threshold shares no band with
probability below ``MISS``.

Defined cases: null texts, and texts without words, have an empty set and are linked
with nothing; repeated rows share set and component, and ``dedup`` keeps one of them; rows that share a doc_id but
not the text are separate nodes; a null doc_id never names a component unless all
its members are null; an empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm.common import checked_broadcast, map_arrow, materialize, ship_code, slices
from scrubline.llm.graph import components

SHINGLE = 5
SHARE = 85  # per cent
ROWS = 6  # sketch coordinates in a band
MISS = 1e-6
BLOCK = 512  # members and strays compared at a time
BLOCK_BYTES = 8 << 20  # of their sets, about
_EMPTY = np.uint64(2**64 - 1)


def n_bands(share: int) -> int:
    """Bands of ``ROWS`` coordinates with which a pair at the threshold is missed with probability below MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - (share / 100) ** ROWS))


def least_agreements(share: int, t: int) -> int:
    """The number of agreeing coordinates of t that a pair at the threshold stays below with probability of at most MISS."""
    p, below, c = share / 100, 0.0, 0
    while c < t:
        below += math.exp(math.lgamma(t + 1) - math.lgamma(c + 1) - math.lgamma(t - c + 1) + c * math.log(p) + (t - c) * math.log1p(-p)) if p < 1 else 0.0
        if below > MISS:
            break
        c += 1
    return c


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and spaces only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out + h[j:j + n])
    return np.unique(out)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set of 64-bit hashes."""
    out = np.full(t, _EMPTY)
    step = max(1, 2 * t // len(items) + 1)  # small sets: several rounds at once, later rounds never win
    start = 0
    while start < 2 * t and (start == 0 or (out == _EMPTY).any()):
        rounds = np.arange(start, min(start + step, 2 * t), dtype=np.uint64)[:, None]
        h = mix(items[None, :] + mix(rounds + np.uint64(0x9E3779B97F4A7C15)))
        bins = np.where(rounds < t, ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32), rounds - np.uint64(t))
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))).ravel())
        start += step
    return mix(out)


def text_key(text: Column) -> Column:
    """A key of a text that any stage can compute; null has one too."""
    return F.coalesce(F.md5(text), F.lit("null"))


def signatures(docs: DataFrame, t: int) -> DataFrame:
    """Per row: doc_id, tkey, n_shingles, cid (digest of the set) and the sketch, 16 bits of each coordinate."""
    source = docs.select("doc_id", "text", text_key(F.col("text")).alias("tkey"))
    schema = T.StructType([source.schema["doc_id"], source.schema["tkey"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("cid", T.BinaryType()), T.StructField("sketch", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for whole in batches:
            for b in slices(whole, "text"):
                n, cid, sk = [], [], []
                for text in b.column("text"):
                    s = shingle_set(text.as_py())
                    n.append(len(s))
                    cid.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sk.append(sketch(s, t).astype("<u2").tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tkey"), pa.array(n, pa.int64()),
                                                  pa.array(cid, pa.binary()), pa.array(sk, pa.binary())], schema=out)

    return map_arrow(source, run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k, n, items): full sets of the classes (k, cid, rep, rep_key), recomputed from the text of their representative."""
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (text_key(F.col("text")) == F.col("rep_key"))  # rep may be null
    rows = docs.select("doc_id", "text").join(wanted, same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                k, n, items = [], [], []
                for text, cid, key in zip(*(b.column(c) for c in ("text", "cid", "k"))):
                    s = shingle_set(text.as_py())
                    if xxhash.xxh3_128_digest(s.tobytes()) == cid.as_py():  # not another text with that key
                        k.append(key.as_py())
                        n.append(len(s))
                        items.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64()), pa.array(items, pa.binary())],
                                                 names=["k", "n", "items"])

    found = map_arrow(rows.select("text", "cid", "k"), run, "k long, n long, items binary")
    return found.groupBy("k").agg(F.first("n").alias("n"), F.first("items").alias("items"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total): sizes of intersection and union of full sets."""
    side = lambda x: sets.select(F.col("k").alias(x), F.col("items").alias(f"items_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                n = shared(x, y)
                common.append(n)
                total.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()),
                                              pa.array(total, pa.int64())], names=["a", "b", "common", "total"])

    return map_arrow(both, run, "a long, b long, common long, total long")


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many items two sorted sets have in common."""
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def rest_links(star: DataFrame, tested: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, share: int, t: int) -> DataFrame:
    """Links (a, b) between the labels of different components that meet in a bucket."""
    away = 1 - F.col("common") / F.col("total")
    one, two = F.least("k", "center"), F.greatest("k", "center")
    rows = (star.filter("size > 2").withColumn("a", one).withColumn("b", two).join(tested, ["a", "b"], "left")
            .withColumn("away", F.when(F.col("k") == F.col("center"), 0.0).otherwise(away))
            .join(labels, "k", "left").withColumn("label", F.coalesce("label", "k")).join(classes.select("k", "n"), "k")
            .select("bkey", "band", "k", "label", "away", "n", (F.col("k") == F.col("center")).alias("is_center")))
    rows = materialize(rows, "near-rest")
    blocks = lambda count, items: F.ceil(F.greatest(count / BLOCK, 8 * items / BLOCK_BYTES)).cast("int")
    buckets = (rows.groupBy("bkey", "label").agg(F.count("*").alias("n"), F.sum("n").alias("items")).groupBy("bkey")
               .agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"),
                    F.sum("n").alias("members"), F.max("n").alias("in_main"), F.sum("items").alias("items")).filter("labels > 1")
               .select("bkey", "main", blocks(F.col("members"), F.col("items")).alias("m_blocks"),
                       blocks(F.col("members") - F.col("in_main"), F.col("items")).alias("s_blocks")))
    held = sets.join(classes.select("k", "sketch"), "k")
    rows = materialize(rows.drop("n").join(buckets, "bkey").join(held, "k"), "near-compare")
    slot = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key, data = ["bkey", "mb", "sb"], ["band", "k", "label", "away", "n", "sketch", "items", "main"]
    members = (rows.filter(~F.col("is_center")).withColumn("mb", slot("m_blocks")).withColumn("sb", each("s_blocks"))
               .select(*key, *data))
    strays = (rows.filter(~F.col("is_center") & (F.col("label") != F.col("main"))).withColumn("sb", slot("s_blocks"))
              .withColumn("mb", each("m_blocks")).select(*[F.col(c).alias(f"s_{c}") for c in key + data]))
    s = share / 100
    limit = least_agreements(share, t)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return none
        col = lambda x, c: x.column(c).to_numpy()
        grid = lambda x, c: np.frombuffer(b"".join(v.as_py() for v in x.column(c)), "<u2").reshape(-1, t)
        lk, ll, la, ln, lmain, ls = col(left, "k"), col(left, "label"), col(left, "away"), col(left, "n"), col(left, "main"), grid(left, "sketch")
        stray = ll != lmain
        a, b, root = [], [], {}
        items = lambda x, c: [np.frombuffer(v.as_buffer(), np.uint64) for v in x.column(c)]
        sets_left = items(left, "items")

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        for k, label, off, n, band, own, mine in zip(*(col(right, f"s_{c}") for c in ("k", "label", "away", "n", "band")),
                                                     grid(right, "s_sketch"), items(right, "s_items")):
            ok = ((ll != label) & (np.abs(la - off) <= 1 - s + 1e-9) & (~stray | (lk > k))
                  & (100 * np.minimum(ln, n) >= share * np.maximum(ln, n)))
            at = np.flatnonzero(ok)
            if len(at):
                same = ls[at] == own
                first = same.reshape(len(at), -1, ROWS).all(2).argmax(1)  # each pair in its first common bucket only
                agree = same.sum(1)
                good = (agree >= limit) & (first == band)
                at, agree = at[good], agree[good]
                for i in at[np.argsort(-agree, kind="stable")].tolist():
                    x, y = find(int(label)), find(int(ll[i]))
                    if x == y:
                        continue
                    common = shared(mine, sets_left[i])
                    if 100 * common >= share * (len(mine) + len(sets_left[i]) - common):
                        root[x] = y
                        a.append(int(label))
                        b.append(int(ll[i]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ship_code(star.sparkSession)
    return members.groupBy(*key).cogroup(strays.groupBy(*[f"s_{c}" for c in key])).applyInArrow(meet, "a long, b long")


def link(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (and tkey, the key of its text; and
    chosen, true for the rows with the doc_id and text that stand for their component in ``dedup``)."""
    bands = n_bands(share)
    t = bands * ROWS
    sig = materialize(signatures(docs, t), "near-sig")
    classes = materialize(
        sig.filter(F.col("cid").isNotNull()).groupBy("cid")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey")).alias("first"),
                              F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("rep", F.col("first.doc_id")).withColumn("k", F.monotonically_increasing_id()), "near-classes")

    # buckets of two classes or more, each with the member that shares most buckets as its centre
    piece = lambda i: F.xxhash64(F.substring("sketch", 2 * ROWS * i + 1, 2 * ROWS), F.lit(i))
    rows = classes.select("k", F.posexplode(F.array(*[piece(i) for i in range(bands)])).alias("band", "bkey"))
    size = F.count("*").over(Window.partitionBy("bkey"))
    members = materialize(rows.repartition("bkey").withColumn("size", size).filter("size > 1"), "near-members")
    weight = members.groupBy("k").agg(F.sum("size").alias("w"))
    wanted = checked_broadcast(materialize(
        weight.join(classes.select("k", "cid", "rep", F.col("first.tkey").alias("rep_key")), "k"), "near-wanted"))
    centers = members.join(wanted.select("k", "w"), "k").groupBy("bkey").agg(F.max_by("k", F.struct("w", -F.col("k"))).alias("center"))
    star = materialize(members.join(centers, "bkey"), "near-star")

    sets = materialize(sets_of(docs, wanted.drop("w")), "near-sets")
    pairs = (star.filter("k != center").select(F.least("k", "center").alias("a"), F.greatest("k", "center").alias("b")).distinct())
    tested = materialize(verify(pairs, sets), "near-tested")
    close = F.expr(f"100 * common >= {int(share)} * total")
    labels = components(tested.filter(close).select("a", "b"), "near-labels", written=True)
    found = materialize(rest_links(star, tested, labels, classes, sets, share, t), "near-found")
    named = classes.select("cid", "k", "first").join(labels, "k", "left").withColumn("label", F.coalesce("label", "k"))
    if not found.isEmpty():
        joined = components(found, "near-joined").select(F.col("k").alias("label"), F.col("label").alias("whole"))
        named = named.join(joined, "label", "left").withColumn("label", F.coalesce("whole", "label")).drop("whole")
    smallest = named.groupBy("label").agg(F.min("first").alias("first"))
    ids = materialize(named.select("cid", "label").join(smallest, "label")
                      .select("cid", F.col("first.doc_id").alias("component_id"), F.col("first.tkey").alias("chosen_key")), "near-ids")
    out = sig.select("doc_id", "tkey", "n_shingles", "cid").join(ids, "cid", "left")
    own = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return (out.withColumn("component_id", own).withColumn("kept", kept)
            .withColumn("chosen", kept & (F.col("cid").isNull() | (F.col("tkey") == F.col("chosen_key"))))
            .select("doc_id", "n_shingles", "component_id", "kept", "tkey", "chosen"))


def dedup(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id, then the smallest key of its text.

    Of repeated rows of that doc_id and text one stays (of other columns the first in order of
    their JSON).  Texts without words are linked with nothing: only rows that repeat their
    doc_id and text go.
    """
    found = (link(docs, share).groupBy(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), "chosen")
             .agg(F.count("*").alias("n"), F.max("n_shingles").alias("size"))
             .filter(~F.col("chosen") | ((F.col("n") > 1) & ((F.col("size") > 0) | F.col("__id").isNotNull()))))
    found = materialize(found, "near-gone")
    key = text_key(F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    single = docs.join(checked_broadcast(found.select("__id", "__key")), same, "left_anti")
    again = found.filter("chosen").select("__id", "__key")
    if again.isEmpty():
        return single
    rows = docs.join(checked_broadcast(again), same, "left_semi")
    others = F.to_json(F.struct("doc_id", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    one = (rows.groupBy(F.col("doc_id").alias("__id"), key.alias("__key"))
           .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), others).alias("__row")))
    return single.unionByName(one.select("__row.*"))
