"""The training-data pipeline: language ID, near-dedup, repeated strings, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import bpe, langid, mixing, neardup, suffixdedup
from scrubline.llm.common import documents, materialize

#: Per cent of shingles that near-duplicates share at least.
NEAR_SHARE = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is clear; the labels of this stage's input train it."""
    kept = langid.predict(docs, langid.fit(docs), keep_rejected=False)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return neardup.dedup(docs, NEAR_SHARE)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out every 200-byte string that stands elsewhere too; n_chars follows the text."""
    out = suffixdedup.dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents so that sources have their target weights."""
    return mixing.apply(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with digests of the ids and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN, with_ids=True)
    return out.select("doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("source_mix", source_mix), ("tokens", tokens)]

#: SQL cannot express compression, sketches or byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
