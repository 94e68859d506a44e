"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import BROADCAST_ROWS, materialize


def components(edges: DataFrame, name: str = "components", written: bool = False) -> DataFrame:
    """(k, label) for every node of the edges (a, b); the label is the smallest node of its component.

    Alternates two star operations until nothing changes (a logarithmic number of
    rounds in practice): the large star hangs the larger neighbours of a node onto
    its smallest neighbour, the small star does so with the smaller ones.  Minima
    are partial aggregates and the joins are plain equi-joins, so a node with very
    many edges is pre-aggregated and split.  Each round is a written table, whose counted
    edges say whether the minima may be broadcast.  ``written``: the edges are distinct
    rows of a written table.
    """
    a, b = F.col("a"), F.col("b")
    e, state = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), None
    e = e if written else materialize(e.distinct(), name)
    while True:
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state or not now[0]:
            break
        state = now
        narrow = F.broadcast if 2 * now[0] <= BROADCAST_ROWS else lambda table: table  # minima: at most two nodes an edge
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(narrow(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(narrow(low), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), name)
    return (e.select(F.col("u").alias("k"), F.col("v").alias("label"))
            .unionByName(e.select(F.col("v").alias("k"), F.col("v").alias("label")).distinct()))
