"""Runs become visible as a whole: manifests, failed and killed runs, concurrent ones, catalog and expiry."""

import os

import pytest
from pyspark.sql import functions as F

from scrubline.operators import mask as M
from scrubline.plans import pipeline
from scrubline.plans.pipeline import run_pipeline
from scrubline.sources import publish

from .conftest import GOLDEN_MASKED


def masked_of(spark, out, number=None):
    return [tuple(r) for r in publish.read(spark, out, "masked", number).orderBy("customer_id").collect()]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_killed_in_the_masked_write_leaves_the_former_output(spark, golden_csv, golden_raw, tmp_dir, monkeypatch, fmt):
    out = os.path.join(tmp_dir, "out")
    first = run_pipeline(spark, golden_csv, out, output_format=fmt)
    assert first.status == "SUCCESS" and first.published == 1
    assert masked_of(spark, out) == GOLDEN_MASKED
    real = M.mask
    monkeypatch.setattr(M, "mask", lambda df: real(df).withColumn("email", F.when(
        F.col("customer_id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("email"))))
    failed = run_pipeline(spark, golden_raw.where("customer_id < 9").repartition(5), out, output_format=fmt)
    assert failed.status == "FAILED" and "lost" in failed.error
    assert masked_of(spark, out) == GOLDEN_MASKED and publish.numbers(spark, out) == [1]
    monkeypatch.setattr(M, "mask", real)

    class Killed(BaseException):
        """Nothing of the job runs after it, as after a kill."""

    write = pipeline.write_table

    def killed(df, path, *how):
        write(df, path, *how)
        if path.endswith("masked") or "masked-" in path:
            raise Killed

    monkeypatch.setattr(pipeline, "write_table", killed)
    with pytest.raises(Killed):
        run_pipeline(spark, golden_raw.where("customer_id < 5"), out, output_format=fmt)
    assert masked_of(spark, out) == GOLDEN_MASKED and publish.numbers(spark, out) == [1]
    monkeypatch.setattr(pipeline, "write_table", write)
    again = run_pipeline(spark, golden_raw.where("customer_id < 5"), out, output_format=fmt)
    assert again.published == 2 and masked_of(spark, out) == GOLDEN_MASKED[:4]
    assert masked_of(spark, out, 1) == GOLDEN_MASKED
    assert publish.read(spark, out, "run_summary").first().input_rows == 4


def put(spark, out, value):
    run, folder = publish.new_run(out)
    df = spark.createDataFrame([(value,)], "v int")
    df.write.parquet(os.path.join(folder, "t"))
    return run, {"t": (f"runs/{run}/t", "parquet", df.schema)}


def test_numbers_are_taken_once(spark, tmp_dir, monkeypatch):
    out = os.path.join(tmp_dir, "out")
    with pytest.raises(FileNotFoundError):
        publish.manifest(spark, out)
    assert publish.commit(spark, out, *put(spark, out, 1)) == 1
    real, stale = publish.numbers, iter([[], [1]])
    monkeypatch.setattr(publish, "numbers", lambda *a: next(stale))  # the listing is older than another commit
    assert publish.commit(spark, out, *put(spark, out, 2)) == 2
    monkeypatch.setattr(publish, "numbers", real)
    assert [publish.read(spark, out, "t", n).first().v for n in (1, 2)] == [1, 2]
    with pytest.raises(FileExistsError):
        publish.commit(spark, out, *put(spark, out, 3), expected=1)
    assert publish.commit(spark, out, *put(spark, out, 4), expected=2) == 3
    with pytest.raises(KeyError):
        publish.read(spark, out, "absent")
    assert not [f for f in os.listdir(os.path.join(out, "runs")) if f.startswith(".manifest")]


def test_expiry_keeps_what_is_named(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    runs = []
    for v in range(4):
        run, tables = put(spark, out, v)
        publish.commit(spark, out, run, tables)
        runs.append(run)
    going_on, _ = put(spark, out, 9)
    assert publish.expire(spark, out, keep=2) == runs[:2]
    assert publish.numbers(spark, out) == [3, 4] and publish.read(spark, out, "t").first().v == 3
    assert sorted(f for f in os.listdir(os.path.join(out, "runs")) if not f.startswith(".")) == sorted([*runs[2:], going_on])
    assert publish.commit(spark, out, *put(spark, out, 5)) == 5


def test_views_and_catalog_follow_the_newest_run(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    spark.sql(f"create database published location '{tmp_dir}/db'")
    try:
        for v in (1, 2):
            publish.commit(spark, out, *put(spark, out, v))
            assert publish.register(spark, out, "now_") == ["now_t"] and spark.table("now_t").first().v == v
            assert publish.save_tables(spark, out, "published") == ["published.t"]
            assert publish.save_tables(spark, out, "published") == ["published.t"]  # again does no harm
            assert spark.table("published.t").first().v == v
    finally:
        spark.sql("drop database published cascade")
