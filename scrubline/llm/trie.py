"""Conversation prefix trie by bursting.

A turn is a symbol of 20 bytes: 16 bytes of a SHA-256 of role and text, 4 bytes with the words
of the text.  A conversation is the string of its symbols, so equal prefixes are equal
bytes and sorted strings are a trie in preorder; texts are read once and never shuffled.
Conversations with equal strings become one weighted suffix first, so copies of a
conversation never fill a container.

Shards hold containers of suffixes under trie heads (one container with all suffixes
at the start).  In each round a container that holds more than ``CONTAINER_TURNS`` turns bursts: the
least and the greatest of its strings (pre-aggregated) tell how far all of them agree, that path
becomes a head, and its suffixes are dealt to new containers by their next turn.  When
no container is oversized, each one is sorted and swept with a stack: a node is finished
when the strings leave it.  Leaves and saved tokens of containers are then summed up
the heads, one grouped sum per round.

The ids of conversations that end at a node are sorted by Spark, joined into chunks of
at most ``CHUNK_IDS`` ids and fed chunk by chunk to the node's SHA-256; the digest runs over its
bytes in order, so a node at which very many conversations end is one stream, not one group in memory.

Defined cases: rows without a conv_id belong to no conversation; null turns come first, and turns
of equal number are in order of the digests of their role and text; repeated rows are turns each;
a null role or text is empty; c % 20 has the sign of c; a text of any length is one symbol; the symbols of one
conversation (20 bytes a turn) are one value; a table without conversations has no nodes.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import BROADCAST_ROWS, map_arrow, materialize, slices

SYMBOL = 20
GROUP = 20       # conversations c - c % GROUP lend the first turns
MAX_LENT = 4     # crc32 of the id modulo this
CONTAINER_TURNS = 16_384
CHUNK_IDS = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, skey binary")


def symbol(role: bytes, text: bytes) -> bytes:
    """A turn as 20 bytes: name and words of its text."""
    name = hashlib.sha256(len(role).to_bytes(8, "big") + role + text).digest()[:SYMBOL - 4]
    return name + len(text.split()).to_bytes(4, "big")


def words_of(seq: bytes, depth: int) -> int:
    """Words of the last turn of the first ``depth`` turns (the root has none)."""
    return int.from_bytes(seq[depth * SYMBOL - 4:depth * SYMBOL], "big") if depth else 0


def common_turns(a: bytes, b: bytes) -> int:
    """How many first turns two strings share."""
    n = min(len(a), len(b)) // SYMBOL
    if a[:n * SYMBOL] == b[:n * SYMBOL]:
        return n
    low = 0  # a[:low] agree, a[:n] do not
    while n - low > 1:
        mid = (low + n) // 2
        low, n = (mid, n) if a[low * SYMBOL:mid * SYMBOL] == b[low * SYMBOL:mid * SYMBOL] else (low, mid)
    return low


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, sym) of every turn."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                pairs = zip(*(b.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text")))
                yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"),
                                                  pa.array([symbol(r, t) for r, t in pairs], pa.binary())],
                                                 names=["conv_id", "turn", "sym"])

    return map_arrow(rows, run, f"conv_id long, turn {kind}, sym binary")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): every conversation with the first turns of the one that it borrows from."""
    own = turns(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.hex("sym").alias("sym")))).alias("t"))
    own = materialize(own.select("conv_id", F.unhex(F.array_join("t.sym", "")).alias("seq")), "trie-own")
    lent = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.expr(f"substring(seq, 1, {SYMBOL * (MAX_LENT - 1)})").alias("head"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MAX_LENT)).cast("int")
    both = (own.withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
            .join(lent, "base", "left"))
    none = F.lit(b"")
    return both.select("conv_id", F.concat(
        F.coalesce(F.expr(f"substring(head, 1, h * {SYMBOL})"), none),
        F.expr(f"substring(seq, h * {SYMBOL} + 1, greatest(length(seq) - h * {SYMBOL}, 0))")).alias("seq"))


def end_digests(convs: DataFrame) -> DataFrame:
    """(skey, ends_sha256): the digest of the ascending ids of all conversations with one string."""
    spark = convs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = convs.select("skey", "conv_id").repartitionByRange(parts, "skey", "conv_id").sortWithinPartitions("skey", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([held[0]], pa.int64()),
                                               pa.array([",".join(map(str, held))])], names=["skey", "first", "ids"])

        for b in batches:
            for k, c in zip(b.column("skey").to_pylist(), b.column("conv_id").to_pylist()):
                if held and (k != key or len(held) == CHUNK_IDS):
                    yield row()
                    held = []
                key = k
                held.append(c)
        if held:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def rows(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()), pa.array([h for _, h in found], pa.string())],
                                              names=["skey", "ends_sha256"])

        for b in batches:
            done = []
            for k, text in zip(b.column("skey").to_pylist(), b.column("ids").to_pylist()):
                if state is not None and k == key:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            yield rows(done)
        if state is not None:
            yield rows([(key, state.hexdigest())])

    cut = map_arrow(ids, chunks, "skey binary, first long, ids string")
    return map_arrow(cut.repartition(parts, "skey").sortWithinPartitions("skey", "first"), digests, "skey binary, ends_sha256 string")


class Sweep:
    """Nodes of one container from its strings in order: (string, weight, smallest id, string key)."""

    def __init__(self, depth: int, parent: int | None):
        self.depth, self.parent = depth, parent
        self.stack: list[dict] = []  # open nodes, from the container's top down
        self.seq = b""

    def add(self, seq: bytes, n: int, first: int, skey: bytes) -> Iterator[tuple]:
        turns_ = len(seq) // SYMBOL
        if self.stack:
            yield from self.leave(common_turns(self.seq, seq))
        self.seq = seq
        for d in range(self.depth + len(self.stack), turns_ + 1):
            self.stack.append({"n": 0, "first": first, "children": 0, "leaves": 0, "saved": 0, "words": words_of(seq, d),
                               "skey": None, "below": []})
        top = self.stack[-1]
        top["n"] += n
        top["first"] = min(top["first"], first)
        top["skey"] = skey

    def leave(self, depth: int) -> Iterator[tuple]:
        """Close the nodes deeper than ``depth``."""
        while self.depth + len(self.stack) - 1 > depth:
            node, d = self.stack.pop(), self.depth + len(self.stack)
            yield from self._closed(node)
            up = self.stack[-1] if self.stack else None
            row = (node["first"], d, None, node["n"], node["children"], node["leaves"], node["saved"], node["skey"])
            if up is None:
                yield row[:2] + (self.parent,) + row[3:]
            else:
                up["n"] += node["n"]
                up["first"] = min(up["first"], node["first"])
                up["children"] += 1
                up["leaves"] += node["leaves"]
                up["saved"] += node["saved"]
                up["below"].append(row)

    @staticmethod
    def _closed(node: dict) -> Iterator[tuple]:
        """Sums of a node without open descendants; its children now know their parent's smallest id."""
        node["leaves"] = node["leaves"] or 1
        node["saved"] += (node["n"] - 1) * node["words"]
        for row in node["below"]:
            yield row[:2] + (node["first"],) + row[3:]

    def end(self) -> Iterator[tuple]:
        yield from self.leave(self.depth - 1)


def swept(closed: DataFrame) -> DataFrame:
    """Nodes of all containers of the table (key, depth, up, pfirst, seq, n, first, skey); ``up`` marks a container's top."""
    rows = closed.select("key", "depth", "up", "pfirst", "seq", "n", "first", "skey")
    rows = rows.repartition(max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "key").sortWithinPartitions("key", "seq")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "skey", "up"]
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sweep, up, out = None, None, None, []

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names=names)

        def put(nodes: Iterator[tuple]) -> None:
            out.extend(node + (up if node[1] == sweep.depth else None,) for node in nodes)

        for b in batches:
            for k, d, u, p, seq, n, first, skey in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    if sweep:
                        put(sweep.end())
                    key, sweep, up = k, Sweep(d, p), u
                put(sweep.add(seq, n, first, skey))
                if len(out) >= 10_000:
                    yield flushed()
                    out = []
        if sweep:
            put(sweep.end())
        yield flushed()

    return map_arrow(rows, run, NODE + ", up binary")


def chains(heads: DataFrame) -> DataFrame:
    """Nodes of the paths that became heads: from ``depth`` to ``deep`` all of them have the same members."""
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "skey"]
    kinds = [pa.int64()] * 7 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                saved, out = r["saved"], []
                for d in range(r["deep"], r["depth"] - 1, -1):
                    saved += (r["n"] - 1) * words_of(r["low"], d)
                    out.append((r["first"], d, r["first"] if d > r["depth"] else r["pfirst"], r["n"],
                                1 if d < r["deep"] else r["children"], max(r["leaves"], 1), saved,
                                r["skey"] if d == r["deep"] else None))
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return map_arrow(heads, run, NODE)


def nodes(conversations: DataFrame, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    convs = materialize(rebuilt(conversations).withColumn("skey", F.unhex(F.sha2("seq", 256))), "trie-convs")
    suffixes = convs.groupBy("skey", "seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    active = materialize(suffixes.select(F.lit(b"").alias("key"), F.lit(0).cast("long").alias("depth"),
                                         F.lit(None).cast("binary").alias("up"), F.lit(None).cast("long").alias("pfirst"),
                                         "seq", "n", "first", "skey"), "trie-suffixes")
    length = F.length("seq") / F.lit(SYMBOL)
    shared = F.udf(lambda a, b: common_turns(a, b), "long")  # one call per container
    done, rounds = [], []
    while True:
        stats = active.groupBy("key", "depth", "up", "pfirst").agg(
            F.sum(length - F.col("depth") + 1).alias("size"), F.min("seq").alias("low"), F.max("seq").alias("high"),
            F.sum("n").alias("n"), F.min("first").alias("first"))
        burst = stats.filter(F.col("size") > container_turns).withColumn("deep", shared("low", "high")).drop("high", "size")
        burst = materialize(burst, "trie-heads")
        n_burst = burst.count()
        if not n_burst:
            done.append(active)
            break
        rounds.append(burst)
        hit = burst.select("key", "deep", F.col("first").alias("head_first"))
        hit = F.broadcast(hit) if n_burst <= BROADCAST_ROWS else hit
        done.append(active.join(hit, "key", "left_anti"))
        # a suffix that ends where its container bursts stays at the head
        moved = active.join(hit, "key").filter(F.length("seq") > F.col("deep") * SYMBOL)
        active = materialize(moved.select(
            F.unhex(F.sha2(F.expr(f"substring(seq, 1, cast((deep + 1) * {SYMBOL} as int))"), 256)).alias("key"),
            (F.col("deep") + 1).alias("depth"), F.col("key").alias("up"), F.col("head_first").alias("pfirst"),
            "seq", "n", "first", "skey"), "trie-suffixes")
    closed = done[0]
    for d in done[1:]:
        closed = closed.unionByName(d)
    found = materialize(swept(closed), "trie-nodes")
    below = found.filter(F.col("up").isNotNull()).groupBy("up").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    out = found.drop("up")
    tops = None  # (up, children, leaves, saved) of the heads of the round below
    for heads in reversed(rounds):
        sums = below if tops is None else below.unionByName(tops).groupBy("up").agg(
            *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
        full = (heads.join(sums.withColumnRenamed("up", "key"), "key", "left")
                .select(*heads.columns, zero("children"), zero("leaves"), zero("saved")))
        ends = F.when(F.length("low") == F.col("deep") * SYMBOL, F.unhex(F.sha2("low", 256)))
        path = materialize(chains(full.withColumn("skey", ends)), "trie-paths")
        out = out.unionByName(path)
        # the first node of each path tells its container's sums
        own = full.select("key", "up", "depth", "first", F.greatest("leaves", F.lit(1)).alias("leaves"), "saved", "n", "low", "deep")
        spent = F.udf(lambda low, a, b, n: (n - 1) * sum(words_of(low, d) for d in range(a, b + 1)), "long")  # one call per head
        tops = own.filter(F.col("up").isNotNull()).groupBy("up").agg(
            F.count("*").alias("children"), F.sum("leaves").alias("leaves"),
            F.sum(F.col("saved") + spent("low", "depth", "deep", "n")).alias("saved"))
        tops = materialize(tops, "trie-sums")
    named = out.filter(F.col("skey").isNotNull()).join(end_digests(convs), "skey", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return named.select(*columns, "ends_sha256").unionByName(
        out.filter(F.col("skey").isNull()).select(*columns, F.lit(NO_ENDS).alias("ends_sha256")))
