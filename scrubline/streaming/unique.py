"""Unique keys in a stream (V2, X3) with row flags that are taken back and state that ends.

Within a horizon, a row fails when another row of its key lies at most ``horizon``
away from it in event time, whichever comes first.  Per key the state holds chains:
maximal runs of rows with no larger gap.  A row that is within the horizon of a
chain belongs to it, and a chain of two rows or more fails as a whole, so a chain is
its two ends, its number of rows and, while there is one row, its id.  A hot key
has no more state than any other: chains lie more than a horizon apart.

A call of the stateful operator, with its reads and writes of state and timers, costs
milliseconds however few rows it gets.  So keys are grouped by a hash into a fixed number of
buckets: a batch makes one call per bucket for rows and one for its timer, however many keys
there are, and the chains of a bucket's keys are one state row, each chain beside its key.

A row is flagged when it arrives; when a partner of an unflagged row arrives later,
that row is reported again with its flag set (a later report of a row replaces the
earlier one, and flags are never taken away).  A chain whose end lies more than a
horizon before the watermark can have no partner any more; a timer drops it.  Rows
behind the watermark are not judged: they go to a table of their own.  So do rows on
time with a null key or time, which cannot fail.

Row ids may repeat or be null: reports are of one row if id, key and time agree, and say of
how many rows they are the first report.  Rows that agree in all three lie within any
horizon of each other, so they have one flag.

After any number of batches the flags equal those of ``flag_rows_within`` over the
rows on time, which is plain SQL windows, and the three tables hold every row once.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_run_dir
from ..sources.tables import table
from .incremental import COMPACT_EVERY, ROCKSDB, _batch_dir, _numbers, file_stream

FLAGS = "row_id string, row_key string, at_us long, failed boolean, rows long"
REPORT = f"{FLAGS}, late boolean"  # rows: of how many rows this is the first report, 0 for a later one
STATE = "keys array<string>, starts array<long>, ends array<long>, sizes array<long>, ids array<string>"
BUCKETS = 1 << 12  # groups of keys that share a call and a state row
NO_TIME = (1 << 63) - 1  # a null time inside the operator: pandas would make a column with nulls floats


def _processor(horizon_us: int):
    """The stateful processor; made in a function so that workers get it by value."""
    from bisect import bisect_right

    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    columns = ["row_id", "row_key", "at_us", "failed", "rows", "late"]

    def start(chain: list) -> int:
        return chain[0]

    class Chains(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("chains", STATE)

        def chains(self) -> dict:
            """The chains of each key of the bucket, by time."""
            held = {}
            for k, *chain in zip(*(self.state.get() or ())):
                held.setdefault(k, []).append(chain)
            return held

        def keep(self, held: dict, watermark_us: int) -> None:
            """Store the chains that can still get a partner, and wake up when the next one cannot."""
            kept = [(k, *c) for k, chains in held.items() for c in chains if c[1] + horizon_us >= watermark_us]
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not kept:
                self.state.clear()
                return
            self.state.update(tuple(list(x) for x in zip(*kept)))
            self.handle.registerTimer((min(c[2] for c in kept) + horizon_us) // 1000 + 1)

        def handleInputRows(self, key, rows, timerValues):
            watermark = timerValues.getCurrentWatermarkInMs()
            held, out = self.chains(), []
            for part in rows:
                for k, row, at in sorted(zip(part["row_key"], part["row_id"], part["at_us"].tolist()), key=lambda r: r[2]):
                    late = at // 1000 < watermark
                    if late or k is None:
                        out.append((row, k, at, False, 1, late))
                        continue
                    chains = held.setdefault(k, [])
                    hi = bisect_right(chains, at, key=start)
                    lo = hi - 1 if hi and at <= chains[hi - 1][1] + horizon_us else hi
                    hi += hi < len(chains) and chains[hi][0] - horizon_us <= at
                    near = chains[lo:hi]  # two at most
                    out += [(c[3], k, c[0], True, 0, False) for c in near if c[2] == 1]
                    out.append((row, k, at, bool(near), 1, False))
                    chains[lo:hi] = [[min([at] + [c[0] for c in near]), max([at] + [c[1] for c in near]), 1 + sum(c[2] for c in near), row]]
            self.keep(held, watermark * 1000)
            yield pd.DataFrame(out, columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.keep(self.chains(), timerValues.getCurrentWatermarkInMs() * 1000)
            yield pd.DataFrame([], columns=columns)

        def close(self) -> None:
            pass

    return Chains()


def micros(df: DataFrame, at: str) -> Column:
    """Microseconds since 1970; a timestamp without zone counts as UTC, whatever the session's zone."""
    if dict(df.dtypes)[at] == "timestamp_ntz":
        t = F.col(at)
        of_day = (F.hour(t) * 60 + F.minute(t)).cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")
        return F.unix_date(t.cast("date")) * F.lit(86_400_000_000) + of_day
    return F.unix_micros(F.col(at).cast("timestamp"))


def run_unique(stream: DataFrame, row_id: str, keys: list[str], at: str, horizon: int, delay: int, out_dir: str,
               compact_every: int = COMPACT_EVERY, buckets: int = BUCKETS) -> dict:
    """Flag the rows of a stream whose ``keys`` recur within ``horizon`` seconds of event time ``at``.

    ``buckets`` bounds the calls and state rows of a batch; it must stay the same for one
    ``out_dir``, which must be new if reports in it are without key and time.  ``delay`` is the watermark's delay in seconds.  Reports go to ``flags/batch_id=N`` and are
    folded into ``flags/base=N`` every ``compact_every`` batches, late rows to ``late/batch_id=N``.  Rows on time
    with a null key or time cannot fail and have no state; they go to ``keyless/batch_id=N``.  Every row of the
    stream is in one of the three.  A replayed batch overwrites its own folders.  Runs until the
    available input is processed.
    """
    spark = stream.sparkSession
    flags, late, keyless = (os.path.join(out_dir, d) for d in ("flags", "late", "keyless"))
    usable = F.col(at).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    # one text that is equal for equal keys only; the time as a plain number, so that the
    # operator sees late rows too instead of dropping them
    rows = stream.select(F.when(usable, F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))).alias("row_key"),
                         F.col(row_id).cast("string").alias("row_id"), micros(stream, at).alias("at_us"))
    timed = rows.withColumn("_time", F.timestamp_micros("at_us")).withWatermark("_time", f"{delay} seconds").drop("_time")
    # rows without a key go through the operator as well, as only it knows the watermark; they are dealt out by id and time
    dealt = F.when(F.col("row_key").isNotNull(), F.xxhash64("row_key")).otherwise(F.xxhash64("row_id", "at_us"))
    keyed = timed.withColumn("bucket", F.pmod(dealt, F.lit(buckets))).withColumn("at_us", F.coalesce("at_us", F.lit(NO_TIME)))
    judged = keyed.groupBy("bucket").transformWithStateInPandas(_processor(horizon * 1_000_000), REPORT, "Update", "EventTime")

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the tables come from one evaluation of the operator
        try:
            batch.where("not late and row_key is not null").drop("late").write.mode("overwrite").parquet(_batch_dir(flags, batch_id))
            batch.where("not late and row_key is null").select("row_id").write.mode("overwrite").parquet(_batch_dir(keyless, batch_id))
            batch.where("late").select("row_id", "row_key", "at_us").write.mode("overwrite").parquet(_batch_dir(late, batch_id))
        finally:
            batch.unpersist()
        if batch_id % compact_every == compact_every - 1:
            _folded(spark, flags, upto=batch_id).write.mode("overwrite").parquet(os.path.join(flags, f"base={batch_id}"))

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        q = (judged.writeStream.outputMode("update").foreachBatch(put)
             .option("checkpointLocation", os.path.join(out_dir, "_checkpoint_unique")).trigger(availableNow=True).start())
        q.awaitTermination()
        progress = [p for p in q.recentProgress if p["stateOperators"]]
    finally:
        spark.conf.set(setting, before)
    return {"flags": flags, "late": late, "keyless": keyless, "state_rows": progress[-1]["stateOperators"][0]["numRowsTotal"] if progress else None}


def _folded(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The last report of each row, from the newest folded table and the batches after it; one for rows that agree in all."""
    batches = [b for b in _numbers(spark, path, "batch_id") if upto is None or b <= upto]
    bases = [b for b in _numbers(spark, path, "base") if upto is None or b < upto]
    last = bases[-1] if bases else -1
    paths = [os.path.join(path, f"base={last}")] if bases else []
    paths += [_batch_dir(path, b) for b in batches if b > last]
    return spark.read.schema(FLAGS).parquet(*paths).groupBy("row_id", "row_key", "at_us") \
        .agg(F.max("failed").alias("failed"), F.sum("rows").alias("rows"))


def latest_flags(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """``(row_id, failed)`` of each row that has a key and was on time, by its last report."""
    last = _folded(spark, path, upto)
    return last.select("row_id", F.explode(F.array_repeat("failed", F.col("rows").cast("int"))).alias("failed"))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(row_id, row_key, at_us)`` of the rows that came behind the watermark."""
    return spark.read.schema("row_id string, row_key string, at_us long").parquet(*[_batch_dir(path, b) for b in _numbers(spark, path, "batch_id")])


def keyless_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(row_id)`` of the rows with a null key or time that were on time; a null time always is."""
    return spark.read.schema("row_id string").parquet(*[_batch_dir(path, b) for b in _numbers(spark, path, "batch_id")])


def flag_rows_within(df: DataFrame, keys: list[str], at: str, horizon: int, name: str = "failed") -> DataFrame:
    """The same rule over a table: whether another row of the keys lies within ``horizon`` seconds."""
    order, t = Window.partitionBy(*keys).orderBy(at), micros(df, at)
    gaps = [t - F.lag(t).over(order), F.lead(t).over(order) - t]
    usable = F.col(at).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    near = [F.coalesce(g <= horizon * 1_000_000, F.lit(False)) for g in gaps]
    return df.withColumn(name, usable & (near[0] | near[1]))


HORIZON, DELAY = 3600, 6 * 3600  # seconds
STRAGGLERS = 97  # every n-th event comes with the last file


def arrive(spark: SparkSession, sf_dir: str, folder: str, n: int = 2):
    """Events as files of ``folder`` that come one after the other: by time, and every ``STRAGGLERS``-th event last.
    Events without a time come first, and one without an id is no straggler."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    t = micros(events, "ts")
    low, high = events.agg(F.min(t), F.max(t)).first()
    step = ((high or 0) - (low or 0)) // n + 1
    straggler = F.coalesce(F.col("event_id") % STRAGGLERS == 0, F.lit(False))
    for i in range(n):
        begin = (low or 0) + i * step
        here = F.coalesce((t >= begin) & (t < begin + step), F.lit(i == 0))
        events.where(~straggler & here).write.mode("append").parquet(folder)
        yield i
    events.where(straggler).write.mode("append").parquet(folder)
    yield n


def stream_unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with whether its user had one of the same type within an hour, as the stream judged it
    (null: it came too late to be judged).  An event on time without user, type or time cannot fail."""
    files, out, found = new_run_dir(spark, "events"), new_run_dir(spark, "stream-unique"), {}
    for _ in arrive(spark, sf_dir, files):  # each arrival is a run of its own: state and watermark live in the checkpoint
        found = run_unique(file_stream(spark, files, "*.parquet"), "event_id", ["user_id", "event_type"], "ts", HORIZON, DELAY, out)
    judged = latest_flags(spark, found["flags"]).select(F.col("row_id").cast("long").alias("event_id"), F.col("failed").alias("failed"))
    missed = late_rows(spark, found["late"]).select(F.col("row_id").cast("long").alias("event_id"), F.lit(None).cast("boolean").alias("failed"))
    keyless = keyless_rows(spark, found["keyless"]).select(F.col("row_id").cast("long").alias("event_id"), F.lit(False).alias("failed"))
    return judged.unionByName(missed).unionByName(keyless)
