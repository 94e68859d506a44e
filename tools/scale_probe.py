"""Throughput and skew probe on a multiplied customer table.

Builds the dirty customer table from ``customer`` at the given scale,
multiplies it ``k`` times with shifted keys, writes it
as a multi-file Parquet table in a fresh scratch folder, and times the main
operators on it.  ``--skew`` makes one key hold a third of all rows, to show
that uniqueness checks pre-aggregate hot keys instead of funnelling them into
one task.

Usage: python tools/scale_probe.py [sf_dir] [k] [--skew]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from scrubline.operators import clean as C  # noqa: E402
from scrubline.operators import mask as M  # noqa: E402
from scrubline.operators import profile as P  # noqa: E402
from scrubline.operators import rules as V  # noqa: E402
from scrubline.operators.rowid import ROW_ID, with_row_id  # noqa: E402
from scrubline.session import local_session, new_run_dir  # noqa: E402
from scrubline.sources.tables import dirty_customers  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    k = int(args[1]) if len(args) > 1 else 100
    skew = "--skew" in sys.argv
    spark = local_session(8, app="scrubline-scale", shuffle_partitions=64)
    base = dirty_customers(spark, sf)
    n = base.count()
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    big = base.select(rep.alias("_rep"), "*").repartition(64, "_rep", "customer_id")
    key = F.col("customer_id") + F.col("_rep") * F.lit(n)
    if skew:  # a third of all rows share key 7
        key = F.when(F.col("customer_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(key)
    big = big.withColumn("customer_id", key).drop("_rep")
    path = new_run_dir(spark, "scale")
    big.write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    rows = df.count()
    suite = V.customer_suite()
    plans = {
        "clean_full": lambda: C.clean(df),
        "mask_full": lambda: M.mask(C.clean(df)),
        "validate": lambda: V.evaluate(df, suite),
        "impact": lambda: V.impact(df, suite),
        "failures": lambda: V.failures(with_row_id(df), suite, ROW_ID),
        "profile_issues": lambda: P.issues(with_row_id(df), ROW_ID),
        "duplicate_keys": lambda: P.duplicate_keys(df),
    }
    out = {}
    for name, mk in plans.items():
        mk().write.format("noop").mode("overwrite").save()
        ts = []
        for _ in range(3):
            t = time.perf_counter()
            mk().write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t)
        sec = sorted(ts)[1]
        out[name] = {"sec": round(sec, 3), "rows_per_sec": int(rows / sec)}
    dup = V.evaluate(df, suite).where("rule_id = 2").first().unexpected_count
    print(json.dumps({"rows": rows, "files": len(df.inputFiles()), "skew": skew, "unique_violations": dup,
                      "timings": out}))
    spark.stop()


if __name__ == "__main__":
    main()
