"""Quality rules kept in a ledger of bit masks.

Every rule is evaluated once per document.  The ledger holds the measurements and
one integer whose bit r says that rule r failed; policies (named, versioned masks
of rules) and ablations never look at a text again.  Ablations count documents by
failure pattern first (at most 2^rules rows whatever the corpus) and then apply
the masks to the patterns.

Measurements of a text (null: as empty): words, code points in words, sign
characters, lines that repeat an earlier line, words inside 3-word windows that
occur at least twice in the text.  All arithmetic is on integers, so results do
not depend on the engine.  Texts of any length are measured whole.

Defined cases: null and empty texts have zeros everywhere and fail the length
rule; blank lines are not lines with a word; extra columns are kept and columns
named like the results are replaced; rows that repeat have a row each; an empty table
gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm.common import map_arrow, materialize, set_columns, with_fields

#: Fixed values of the contract: the sign characters and ASCII white space.
SIGNS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: name -> condition under which a document fails; the position is the bit.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "many_signs": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}

#: Versioned policies: the rules that a document must not fail.
POLICIES: dict[str, tuple[str, ...]] = {
    "v0": ("few_words", "repeated_windows"),
    "v1": tuple(RULES),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    """The failure bits that a policy looks at."""
    return sum(bit(r) for r in POLICIES[policy])


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() cuts at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in SPACES)
    signs = sum(text.count(c) for c in SIGNS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), chars, signs, len(lines) - len(set(lines)), repeated_words(words), len(lines))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words covered by windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    window = ids[:n]
    for k in range(1, width):  # exact: windows are renumbered before the next word joins
        window = window * len(names) + ids[k:n + k]
        if k < width - 1:
            window = np.unique(window, return_inverse=True)[1]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def ledger(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per document: the kept columns, the measurements and ``fail_bits``."""
    kept = docs.columns if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`") for c in kept], *([] if "text" in kept else ["text"]))
    fields = [T.StructField(m, T.LongType()) for m in MEASURES]
    schema = with_fields(T.StructType([f for f in source.schema.fields if f.name in kept]), *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in batches:
            got = np.array([measure_text(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(MEASURES))
            yield set_columns(batch, out, **{m: pa.array(got[:, i]) for i, m in enumerate(MEASURES)})

    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    fail = bits[0]
    for b in bits[1:]:
        fail = fail.bitwiseOR(b)
    return map_arrow(source, run, schema).withColumn("fail_bits", fail)


def passes(policy: str) -> Column:
    """Does a ledger row pass the policy?"""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def store(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The ledger as a written table: texts are measured once, every policy and ablation reads the table."""
    return materialize(ledger(docs, keep), "quality-ledger")


def compare(book: DataFrame, *policies: str) -> DataFrame:
    """Per policy and rule of it: how many documents fail the rule, fail only it, pass the policy, and pass without the rule.

    The corpus is reduced to one row per failure pattern (partial aggregation, at
    most 2^rules rows), whatever the number of policies; every figure is a bitwise sum
    over the patterns.  A ledger without rows gives none.
    """
    patterns = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    tested = patterns.select("fail_bits", "n", F.inline(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(p)).alias("full"), F.lit(bit(r)).alias("own"))
        for p in policies for r in POLICIES[p]])))
    hit, own = F.col("fail_bits").bitwiseAND(F.col("full")), F.col("own")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return tested.groupBy("policy", "rule").agg(
        count(hit.bitwiseAND(own) != 0).alias("n_failed"), count(hit == own).alias("n_failed_only_this"),
        count(hit == 0).alias("n_kept"), count(hit.bitwiseAND(F.bitwise_not(own)) == 0).alias("n_kept_without"))


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """``compare`` for one policy."""
    return compare(book, policy).drop("policy")
