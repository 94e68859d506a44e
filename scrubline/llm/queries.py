"""Named queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm import (
    ann, audit, bpe, langid, mixing, neardup, quality, recompress, suffixdedup, tokenfiles, trie, vafile, warc,
)
from scrubline.llm.common import documents


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through deduplicated archives."""
    records = warc.dedup(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings of 200 bytes."""
    return suffixdedup.report(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return (mixing.plan(documents(spark, sf_dir))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdict of every document."""
    book = quality.store(documents(spark, sf_dir), keep=["doc_id"])
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes("v0")).alias("base_failed"), quality.passes("v1").alias("kept"),
                       "n_lines", "fail_bits")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of both policies takes, from one stored ledger."""
    return quality.compare(quality.store(documents(spark, sf_dir), keep=["doc_id"]), "v0", "v1")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    docs = documents(spark, sf_dir)
    manifest = tokenfiles.write(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfiles.read(spark, manifest, docs.schema["doc_id"].dataType)


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated windows of 35 words."""
    return recompress.report(documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes that they decode to, as digests."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.link(documents(spark, sf_dir)).drop("tkey", "chosen")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = documents(spark, sf_dir)
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every twentieth vector, exactly."""
    return vafile.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How five filters interact in every order, by source."""
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_suffix_dedup, op3_mixing, op4_quality, op5_tokens, op6_recompression, op7_bpe,
                                   op8_neardup, op9_ann, op10_langid, op11_trie, op12_vafile, op13_audit, quality_ablations)}
