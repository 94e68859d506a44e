"""CSV source, sinks, the end-to-end job and the streaming path."""

import os

import pytest

from scrubline.plans.pipeline import run_pipeline
from scrubline.sources.csv import read_csv, row_counts

from .conftest import GOLDEN_CLEANED, GOLDEN_MASKED, SF_SMALL


def test_csv_scan_types_and_counts(golden_raw):
    assert golden_raw.dtypes[0] == ("customer_id", "bigint")
    assert dict(golden_raw.dtypes)["income"] == "double"
    r = row_counts(golden_raw).first()
    assert (r.row_count, r.column_count) == (10, 10)


def test_csv_na_tokens_and_bad_cells(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,income\n1, NA,abc\n2,null,NaN\n3,  Bob ,12.5\nx,N/A,\n")
    df = read_csv(spark, path, "customer_id BIGINT, first_name STRING, income DOUBLE", keep_bronze=True)
    rows = sorted(df.collect(), key=lambda r: (r.customer_id is None, r.customer_id or 0))
    assert [r.first_name for r in rows] == [None, None, "Bob ", None]
    assert [r.income for r in rows] == [None, None, 12.5, None]
    assert rows[0].income__raw == "abc"
    assert rows[3].customer_id is None and rows[3].customer_id__raw == "x"


def test_csv_phone_never_numeric(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.csv")
    with open(path, "w") as f:
        f.write("customer_id,phone\n1,5551234567\n2,\n")
    df = read_csv(spark, path, "customer_id BIGINT, phone STRING")
    assert [r.phone for r in df.orderBy("customer_id").collect()] == ["5551234567", None]


def test_minimal_csv_subset(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,last_name\n1,John,Doe\n2,Jane,Smith\n")
    df = read_csv(spark, path, "customer_id BIGINT, first_name STRING, last_name STRING")
    assert df.count() == 2


def test_missing_file_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, os.path.join(tmp_dir, "absent.csv"))


def test_pipeline_end_to_end(spark, golden_csv, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    res = run_pipeline(spark, golden_csv, out)
    assert res.status == "SUCCESS", res.error
    assert [tuple(r) for r in res.cleaned.orderBy("customer_id").collect()] == GOLDEN_CLEANED
    assert [tuple(r) for r in res.masked.orderBy("customer_id").collect()] == GOLDEN_MASKED
    assert res.fix_counters == {"phone_fixes": 10, "phone_changed": 3, "date_fixes": 2, "name_fixes": 1,
                                "email_fixes": 1}
    summary = res.reports["run_summary"].first()
    assert (summary.input_rows, summary.output_rows, summary.quality_status) == (10, 10, "FAIL")
    log = {r.metric: (r.value, r.status) for r in res.reports["cleaning_log"].collect()}
    assert log["failures_before"] == (6, None)
    assert log["failures_after"] == (4, "REVIEW REQUIRED")
    for name in ("validation_raw", "profile_report", "pii_report", "masked_sample", "run_report"):
        assert os.path.isdir(os.path.join(res.run_dir, "reports", name))


def test_pipeline_csv_sink(spark, golden_csv, tmp_dir):
    out = os.path.join(tmp_dir, "csvout")
    res = run_pipeline(spark, golden_csv, out, output_format="csv")
    assert res.status == "SUCCESS", res.error
    from scrubline.sources.csv import read_export
    exported = read_export(spark, os.path.join(res.run_dir, "masked"), res.masked.schema)
    assert sorted(map(str, exported.collect())) == sorted(map(str, res.masked.collect()))


def test_pipeline_missing_input_is_captured(spark, tmp_dir):
    out = os.path.join(tmp_dir, "bad")
    res = run_pipeline(spark, os.path.join(tmp_dir, "missing.csv"), out)
    assert res.status == "FAILED"
    assert "FileNotFoundError" in res.error
    assert spark.read.parquet(os.path.join(res.run_dir, "reports", "run_report")).first().stage == "FAILED"
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, os.path.join(tmp_dir, "missing.csv"), out, fail_fast=True)


def test_pipeline_quality_gate_halts(spark, golden_csv, tmp_dir):
    """The gate judges the raw table (filling would remove its nulls) before anything is written."""
    out = os.path.join(tmp_dir, "gate")
    res = run_pipeline(spark, golden_csv, out, critical={7: 0.1})
    assert res.status == "FAILED" and "QualityGateError" in res.error
    assert os.listdir(out) == ["runs"] and os.listdir(res.run_dir) == ["reports"]
    assert os.listdir(os.path.join(res.run_dir, "reports")) == ["run_report"]
    detail = spark.read.parquet(os.path.join(res.run_dir, "reports", "run_report")).first().detail
    assert detail.startswith("Traceback") and "check_gate" in detail
    assert run_pipeline(spark, golden_csv, os.path.join(tmp_dir, "open"), critical={7: 0.11}).status == "SUCCESS"
    res = run_pipeline(spark, golden_csv, os.path.join(tmp_dir, "late"), critical={12: 0.05}, gate_on="cleaned")
    assert res.status == "FAILED" and not os.path.exists(os.path.join(res.run_dir, "masked"))


def test_columns_are_bound_by_header_name(spark, tmp_dir):
    """Reordered, extra and missing columns: each value lands under its own name and is masked as such."""
    path = os.path.join(tmp_dir, "mixed.csv")
    with open(path, "w") as f:
        f.write('tier,customer_id,email,first_name,last_name,income\n'
                'gold,1,john@x.com,John,Doe,abc\n"a, b",2,jane@x.com,"Ja""ne","Ro, e",12.5\n')
    df = read_csv(spark, path)
    assert df.columns == ["customer_id", "first_name", "last_name", "email", "income"]
    rows = [tuple(r) for r in df.orderBy("customer_id").collect()]
    assert rows == [(1, "John", "Doe", "john@x.com", None), (2, 'Ja"ne', "Ro, e", "jane@x.com", 12.5)]
    assert read_csv(spark, path, keep_extra=True).orderBy("customer_id").collect()[1].tier == "a, b"
    with pytest.raises(ValueError, match="phone"):
        read_csv(spark, path, required=("customer_id", "phone"))
    from scrubline.operators import mask as M
    masked = M.mask(df).orderBy("customer_id").first()
    assert (masked.first_name, masked.last_name, masked.email) == ("J***", "D***", "j***@x.com")


def test_files_with_other_headers_are_refused(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    for name, text in (("a.csv", "customer_id,email,first_name\n1,a@b.io,Al\n"), ("b.csv", "customer_id,first_name,email\n2,Bo,b@b.io\n")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, folder).collect()


def test_csv_export_reads_back_value_for_value(spark, tmp_dir):
    from scrubline.sources.csv import read_export, write_table
    values = [" Doe ", "", None, 'a "q", b', "x\ny", '"', '""', "end\\", "#c", " ,", "NA", "tab\t", "1.0E300"]
    df = spark.createDataFrame([(i, v, None if i % 2 else i / 3) for i, v in enumerate(values)], "id long, s string, d double")
    path = os.path.join(tmp_dir, "exp")
    write_table(df, path, "csv")
    back = read_export(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_pipeline_counts_what_it_could_not_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,last_name,email,phone,date_of_birth,address,income,account_status,created_date\n"
                '1,A b,C d,e@f.io,5551234567,1/5/24,"1 A ""St"", NY",abc,active,2024-01-10 10:30\n'
                "x,A b,C d,e@f.io,5551234567,someday,NY,1.5,active,2024-01-10\n3,short\n")
    res = run_pipeline(spark, path, os.path.join(tmp_dir, "o"), output_format="csv")
    assert res.status == "SUCCESS", res.error
    log = {r.metric: r.value for r in res.reports["cleaning_log"].collect() if r.section in ("load", "unparsed")}
    assert log == {"malformed_rows": 1, "unreadable_customer_id": 1, "unreadable_income": 1, "date_of_birth": 1, "created_date": 0}
    assert [r.value for r in spark.read.parquet(os.path.join(res.run_dir, "reports", "date_rejects")).collect()] == ["someday"]
    run = {r.metric: r.value for r in res.reports["run_report"].collect()}
    assert run["masked_rows"] == res.masked.count() == 3
    got = {r.customer_id: (r.date_of_birth, r.created_date, r.address) for r in res.cleaned.collect()}
    assert got[1] == ("2024-01-05", "2024-01-10", '1 A "St", NY')


def test_streaming_matches_batch(spark):
    from scrubline.plans.catalog import masked
    from scrubline.streaming.incremental import stream_masked_customers
    streamed = sorted(map(str, stream_masked_customers(spark, SF_SMALL).collect()))
    batch = sorted(map(str, masked(spark, SF_SMALL).collect()))
    assert streamed == batch


def test_stream_processes_new_files_and_keeps_key_state(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from scrubline.streaming.incremental import file_stream, latest_counts, run_key_counts

    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    first = pa.table({"o_orderkey": [1, 2, 3, 4], "o_custkey": [10, 10, 20, 30]})
    second = pa.table({"o_orderkey": [5, 6], "o_custkey": [20, 40]})
    pq.write_table(first, os.path.join(src, "orders-1.parquet"))
    path = run_key_counts(file_stream(spark, src, "orders-*.parquet"), "o_custkey", out)
    got = {r.o_custkey: r.occurrences for r in latest_counts(spark, path, "o_custkey").collect()}
    assert got == {10: 2, 20: 1, 30: 1}

    pq.write_table(second, os.path.join(src, "orders-2.parquet"))   # a file arrives later
    run_key_counts(file_stream(spark, src, "orders-*.parquet"), "o_custkey", out)  # same checkpoint
    got = {r.o_custkey: r.occurrences for r in latest_counts(spark, path, "o_custkey").collect()}
    assert got == {10: 2, 20: 2, 30: 1, 40: 1}   # state kept across runs, old file not re-read


def test_operators_on_a_column_subset(spark, tmp_dir):
    from pyspark.sql import Observation

    from scrubline.operators import clean as C
    from scrubline.operators import mask as M
    from scrubline.operators import profile as P

    path = os.path.join(tmp_dir, "sub.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,last_name\n1,john,DOE\n2,,o'neil\n")
    df = read_csv(spark, path, "customer_id BIGINT, first_name STRING, last_name STRING")
    assert [tuple(r) for r in C.clean(df).orderBy("customer_id").collect()] == [
        (1, "John", "Doe"), (2, "[UNKNOWN]", "O'Neil")]
    obs = Observation("c")
    C.clean_observed(df, obs).collect()
    assert obs.get["name_fixes"] == 3 and obs.get["missing__first_name"] == 1
    assert [tuple(r) for r in M.mask(C.clean(df)).orderBy("customer_id").collect()] == [
        (1, "J***", "D***"), (2, "[UNKNOWN]", "O***")]
    assert P.completeness(df).count() == 3


def test_csv_short_and_long_rows_are_captured(spark, tmp_dir):
    path = os.path.join(tmp_dir, "shift.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name,income\n1,Ann,10\n2,Bob\n3,Cy,30,extra\n4,Di,40\n")
    df = read_csv(spark, path, "customer_id BIGINT, first_name STRING, income DOUBLE",
                  corrupt_column="_corrupt_record")
    bad = {r.customer_id: r._corrupt_record for r in df.collect() if r._corrupt_record is not None}
    assert bad == {2: "2,Bob", 3: "3,Cy,30,extra"}


def test_key_state_over_many_batches_restart_and_compaction(spark, tmp_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from scrubline.streaming.incremental import _numbers, file_stream, latest_counts, run_key_counts

    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    want = {}

    def arrive(n):
        keys = [n % 3, n, n]
        pq.write_table(pa.table({"k": keys}), os.path.join(src, f"part-{n}.parquet"))
        for k in keys:
            want[k] = want.get(k, 0) + 1

    for n in range(5):
        arrive(n)
    path = run_key_counts(file_stream(spark, src, "part-*.parquet", 1), "k", out, compact_every=2)
    assert {r.k: r.occurrences for r in latest_counts(spark, path, "k").collect()} == want
    for n in range(5, 8):
        arrive(n)
    run_key_counts(file_stream(spark, src, "part-*.parquet", 1), "k", out, compact_every=2)
    assert {r.k: r.occurrences for r in latest_counts(spark, path, "k").collect()} == want
    assert len(_numbers(spark, path, "batch_id")) == 8 and _numbers(spark, path, "base") == [1, 3, 5, 7]


def test_csv_files_as_a_stream(spark, tmp_dir):
    from scrubline.streaming.incremental import stream_masked_csv

    src, out = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "masked")
    os.makedirs(src)
    head = "email,customer_id,last_name,first_name,phone,date_of_birth,address,income,account_status,created_date\n"
    for n in range(2):
        with open(os.path.join(src, f"f{n}.csv"), "w") as f:
            f.write(head + f"a{n}@x.io,{n},Doe,jo,5551234567,1985/03/15,NY,1.0,active,2024-01-10\n")
    paths = stream_masked_csv(spark, src, out, max_files_per_trigger=1)
    rows = spark.read.parquet(paths["masked"]).orderBy("customer_id").collect()
    assert [(r.customer_id, r.first_name, r.email, r.date_of_birth) for r in rows] == [
        (0, "J***", "a***@x.io", "1985-**-**"), (1, "J***", "a***@x.io", "1985-**-**")]
    counted = spark.read.parquet(paths["batch_metrics"])
    assert counted.where("rule_id = 1").agg({"element_count": "sum"}).first()[0] == 2
