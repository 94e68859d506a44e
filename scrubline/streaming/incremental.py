"""Run on arrival of new files (X3) with Structured Streaming.

Cleaning, masking and the row-level rules are stateless projections, so the
same functions apply unchanged to a streaming DataFrame.  Uniqueness across
micro-batches needs keyed state: a streaming ``groupBy(key).count()`` keeps
one counter per key in the (distributed, checkpointed) state store, and the
keys whose counter passes one are the duplicates seen so far.

Outputs go to the shared folder (``spark.checkpoint.dir``) together with the
query checkpoints, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import mask as M
from ..operators import rules as V
from ..session import new_run_dir
from ..sources.csv import stream_csv
from ..sources.tables import dirty_from


def file_stream(spark: SparkSession, directory: str, file_glob: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of ``directory`` whose names match ``file_glob``;
    files that arrive later are picked up by the next trigger."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(directory).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def customer_file_stream(spark: SparkSession, directory: str, file_glob: str = "customer*.parquet") -> DataFrame:
    """Stream ``customer`` files as the dirty customer table."""
    return dirty_from(file_stream(spark, directory, file_glob))


def run_clean_mask(stream: DataFrame, out_dir: str, rules=None) -> dict:
    """Clean + mask every micro-batch into ``out_dir/masked`` and append per-batch
    rule results to ``out_dir/batch_metrics``.  Runs until the available input
    is processed (``availableNow``) and returns the output paths.

    A batch is evaluated once: the rule counters are observed on the cleaned rows
    while the masked ones are written.
    """
    rules = rules or V.customer_suite()
    row_rules = [r for r in rules if r.kind != "unique"]  # uniqueness is the keyed-state query
    masked_path = os.path.join(out_dir, "masked")
    metrics_path = os.path.join(out_dir, "batch_metrics")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # foreachBatch is at-least-once: each batch overwrites its own folder,
        # so a batch replayed after a failure or restart is written once
        cleaned, seen = C.clean(batch), Observation()
        counted = cleaned.observe(seen, F.count(F.lit(1)).alias("rows"),
                                  *[F.count_if(r.unexpected(cleaned)).alias(f"u{r.rule_id}") for r in row_rules])
        M.mask(counted).write.mode("overwrite").parquet(_batch_dir(masked_path, batch_id))
        got = seen.get
        batch.sparkSession.createDataFrame(
            [(r.rule_id, r.column, r.expectation, got["rows"], got[f"u{r.rule_id}"], got[f"u{r.rule_id}"] == 0) for r in row_rules],
            "rule_id int, column_name string, expectation string, element_count bigint, unexpected_count bigint, success boolean",
        ).write.mode("overwrite").parquet(_batch_dir(metrics_path, batch_id))

    q = (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", os.path.join(out_dir, "_checkpoint_clean"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return {"masked": masked_path, "batch_metrics": metrics_path}


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COMPACT_EVERY = 10  # batches after which the key table is folded into one


def run_key_counts(stream: DataFrame, key: str, out_dir: str, compact_every: int = COMPACT_EVERY) -> str:
    """Keyed state across batches: running count per key, upserted per batch.

    The counters live in a RocksDB state store (off the heap, checkpointed with the
    query).  Each micro-batch emits only the keys it touched (update mode) into its own
    ``batch_id=N`` folder; every ``compact_every`` batches the newest count of each key is
    written to ``base=N``, so a reader sees one current table and the few batches
    after it.  A replayed batch overwrites its own folders.
    """
    spark = stream.sparkSession
    counts_path = os.path.join(out_dir, "key_counts")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.col(key), F.col("occurrences")) \
            .write.mode("overwrite").parquet(_batch_dir(counts_path, batch_id))
        if batch_id % compact_every == compact_every - 1:
            latest_counts(spark, counts_path, key, upto=batch_id) \
                .write.mode("overwrite").parquet(os.path.join(counts_path, f"base={batch_id}"))

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        q = (
            stream.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
            .writeStream.outputMode("update").foreachBatch(upsert)
            .option("checkpointLocation", os.path.join(out_dir, "_checkpoint_keys"))
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
    finally:
        spark.conf.set(setting, before)
    return counts_path


def _batch_dir(path: str, batch_id: int) -> str:
    return os.path.join(path, f"batch_id={batch_id}")


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """N of the folders ``name=N`` under ``path`` (a listing, no data is read)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"{name}=*"))
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found or [])


def latest_counts(spark: SparkSession, counts_path: str, key: str, upto: int | None = None) -> DataFrame:
    """Latest running count per key: the newest compacted table and the batches after it.

    Counts only grow, so the largest one is the latest.
    """
    batches = [b for b in _numbers(spark, counts_path, "batch_id") if upto is None or b <= upto]
    bases = [b for b in _numbers(spark, counts_path, "base") if upto is None or b < upto]
    last = bases[-1] if bases else -1
    paths = [os.path.join(counts_path, f"base={last}")] if bases else []
    paths += [_batch_dir(counts_path, b) for b in batches if b > last]
    return spark.read.parquet(*paths).groupBy(key).agg(F.max("occurrences").alias("occurrences"))


def stream_masked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked customer table produced incrementally from the customer file."""
    out = new_run_dir(spark, "stream-mask")
    paths = run_clean_mask(customer_file_stream(spark, sf_dir, "customer.parquet"), out)
    return spark.read.parquet(paths["masked"]).drop("batch_id")


def stream_masked_csv(spark: SparkSession, directory: str, out_dir: str, **how) -> dict:
    """CSV files as they arrive, cleaned and masked (columns by header name)."""
    return run_clean_mask(stream_csv(spark, directory, **how), out_dir)


def stream_duplicate_keys(spark: SparkSession, sf_dir: str, table: str = "orders",
                          key: str = "o_custkey") -> DataFrame:
    """Keys seen more than once across the stream (keyed streaming state)."""
    stream = file_stream(spark, sf_dir, f"{table}.parquet")
    out = new_run_dir(spark, "stream-keys")
    counts = latest_counts(spark, run_key_counts(stream, key, out), key)
    return counts.where(F.col("occurrences") > 1).select(key, F.col("occurrences").cast("bigint"))
