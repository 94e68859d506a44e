"""Mixing sources to target weights by capped water-filling.

Targets: every source gets the share of the budget that its weight asks for; a
source may be repeated at most ``max_epochs`` times, so sources that would go
beyond are clamped there and the rest of the budget is dealt anew by weight
among the others, until no one is above.  Each round is one aggregate over the
one-row-per-source table; the driver only sees two sums a round.

Sampling: a source with target t and size s is taken ``floor(t / s)`` times as a
whole and then a seeded fraction once more.  The fraction is a prefix of the
source in the order of a seeded hash, rounded to whole documents at the boundary;
one closing swap (the document whose size is nearest to what is left over) brings
the source as near to its target as its documents allow.  Prefix sums run on two
levels (hash buckets of each source, then inside a bucket), so a source that
holds a third of all rows is spread over many tasks.

Defined cases: null text has size 0; a null source is a source of its own, last in
order; rows that agree in doc_id, source and size are decided together; sources
without words get target 0; an empty table gives an empty result; extra columns
are not read by ``plan`` and are kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.common import WORD, materialize

#: Fixed values of the mixing contract: weights by rank of the source, budget, cap.
WEIGHT_CYCLE = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2.0


def text_size(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Source as a non-null string: null and text never meet."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = WEIGHT_CYCLE) -> DataFrame:
    """Weights dealt in turn to sources in code point order, null last (one row per source)."""
    order = Window.orderBy(F.col("skey") == "n", "skey")
    deal = F.array(*[F.lit(float(w)) for w in cycle])
    rank = F.row_number().over(order) - 1
    return sources.withColumn("weight", F.element_at(deal, (rank % len(cycle) + 1).cast("int")))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to a table (skey, source_size, weight) with one row per source.

    ``level`` is the words per unit of weight that the unclamped sources get.  It
    only rises from round to round, so the clamped set (cap below weight x level)
    only grows; the rounds end when it stands still.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = -1.0
    while True:
        clamped = cap < F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(clamped, cap).otherwise(0.0)).alias("c"),
                          F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        held, weight = row["c"] or 0.0, row["w"] or 0.0
        new = (budget - held) / weight if weight > 0 else float("inf")
        if new <= level or weight <= 0:
            level = max(level, new) if weight <= 0 else level
            break
        level = new
    if level == float("inf"):
        return sources.withColumn("target", cap)
    want = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(cap < want, cap).otherwise(want))


def plan(docs: DataFrame, max_epochs: float = MAX_EPOCHS, budget: float = BUDGET, seed: int = 7,
         weights=cycle_weights, rows_per_bucket: int = 200_000) -> DataFrame:
    """How often each document is taken: one row per (doc_id, source, size) with its number of copies.

    Columns: doc_id, source, skey, size, copies, source_size, target, reps (times a
    copy is taken).  ``weights`` maps the one-row-per-source table (skey,
    source_size) to the same with ``weight``.
    """
    units = materialize(
        docs.select("doc_id", "source", source_key(F.col("source")).alias("skey"), text_size(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "skey", "size").agg(F.count("*").alias("copies")), "mix-units")
    sources = weights(units.groupBy("skey").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")))
    sources = materialize(sources, "mix-sources")
    total, rows = (x or 0 for x in units.agg(F.sum(F.col("size") * F.col("copies")), F.count("*")).first())
    filled = water_fill(sources, budget * total, max_epochs)
    n = F.col("source_size")
    whole = F.when(n > 0, F.floor(F.col("target") / n)).otherwise(F.lit(0)).cast("long")
    filled = filled.withColumn("whole", whole).withColumn("left_words", F.col("target") - F.col("whole") * n)

    # two-level prefix sums in seeded hash order; the bucket is a prefix of the hash
    digits = 1
    while 16 ** digits * rows_per_bucket < rows and digits < 6:
        digits += 1
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    keyed = (units.withColumn("key", key).withColumn("bucket", F.substring("key", 1, digits))
             .withColumn("words", F.col("size") * F.col("copies")))
    bases = keyed.groupBy("skey", "bucket").agg(F.sum("words").alias("bucket_words"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (bases.withColumn("base", F.coalesce(F.sum("bucket_words").over(before), F.lit(0)))
             .join(filled, "skey"))
    inside = (Window.partitionBy("skey", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (keyed.join(bases, ["skey", "bucket"])
              .withColumn("start", F.col("base") + F.coalesce(F.sum("words").over(inside), F.lit(0)))
              .withColumn("picked", (F.col("words") > 0)
                          & (F.col("start") + F.col("words") / F.lit(2.0) <= F.col("left_words"))))
    placed = materialize(placed.select("doc_id", "source", "skey", "size", "copies", "words", "source_size", "target",
                                       "whole", "left_words", "key", "start", "picked"), "mix-placed")

    # closing swap: at most one document per source enters or leaves
    got = placed.groupBy("skey").agg(F.max("left_words").alias("want"),
                                     F.sum(F.when(F.col("picked"), F.col("words")).otherwise(0)).alias("got"))
    rest = F.col("want") - F.col("got")
    near = F.abs(F.col("words") - F.abs(F.col("rest")))
    able = (F.col("words") > 0) & (F.col("picked") == (F.col("rest") < 0)) & (near < F.abs(F.col("rest")))
    swap = (placed.join(got.withColumn("rest", rest), "skey")
            .filter(able & (F.col("left_words") > 0))
            .groupBy("skey").agg(F.min(F.struct(near.alias("near"), "key", "start")).alias("s"))
            .select("skey", F.col("s.key").alias("key"), F.col("s.start").alias("start"), F.lit(True).alias("swap")))
    return (placed.join(swap, ["skey", "key", "start"], "left")
            .withColumn("picked", F.col("picked") != (F.coalesce("swap", F.lit(False)) & (F.col("words") > 0)))
            .withColumn("reps", F.col("whole") + F.col("picked").cast("long"))
            .select("doc_id", "source", "skey", "size", "copies", "source_size", "target", "reps"))


def apply(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: every column of ``docs``, each row as often as the plan takes it."""
    p = plan(docs, **how).select(F.col("doc_id").alias("__id"), F.col("skey").alias("__skey"),
                                 F.col("size").alias("__size"), F.col("reps").alias("__reps"))
    d = (docs.withColumn("__k", source_key(F.col("source"))).withColumn("__n", text_size(F.col("text"))))
    return (d.join(p.filter("__reps > 0"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__skey"))
                   & (F.col("__n") == F.col("__size")))
            .withColumn("__rep", F.explode(F.sequence(F.lit(1), F.col("__reps"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
