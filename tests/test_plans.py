"""Physical-plan properties that matter at scale (checked on the planned query)."""

import re

from scrubline.operators import clean as C
from scrubline.operators import mask as M
from scrubline.operators import pii as D
from scrubline.operators import rules as V
from scrubline.plans.catalog import raw
from scrubline.sources.tables import table

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", p)


def test_clean_and_mask_do_not_shuffle(spark):
    p = plan(M.mask(C.clean(raw(spark, SF_SMALL))))
    assert "Exchange" not in p
    # the customer scan reads only the three columns the dirty table is built from
    assert read_schemas(p) == ["c_custkey:bigint,c_name:string,c_acctbal:double"]


def test_suite_is_one_aggregate_plus_one_key_shuffle(spark):
    p = plan(V.evaluate(raw(spark, SF_SMALL), V.customer_suite()))
    assert p.count("Exchange SinglePartition") == 2          # one per result leg, one row each
    assert p.count("Exchange hashpartitioning") == 1         # the uniqueness groupBy
    assert "partial_count" in p                               # map-side partial aggregation
    assert "Join" not in p


def test_impact_needs_no_join(spark):
    p = plan(V.impact(raw(spark, SF_SMALL), V.customer_suite()))
    assert "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1


def test_failure_samples_limit_before_the_shuffle(spark):
    p = plan(V.failures(raw(spark, SF_SMALL), V.customer_suite(), "customer_id"))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_failure_samples_read_the_table_once(spark):
    p = plan(V.failures(raw(spark, SF_SMALL), V.customer_suite(), "customer_id"))
    assert scans_in(p) == 1 and "Join" not in p and "HashAggregate" not in p
    assert scans_in(plan(V.failures(raw(spark, SF_SMALL), V.customer_suite(), "customer_id", rescan=True))) == 3


def test_segment_profile_reads_once(spark):
    from scrubline.operators.segments import profile_by_segment

    p = plan(profile_by_segment(raw(spark, SF_SMALL)))
    assert p.count("FileScan") == 1 and "Join" not in p and "Expand" in p
    keyed = [re.findall(r"(\w+)#", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)]
    seg = ["_s_account_status", "_s_created_year"]  # from the last shuffle to the first
    assert keyed == [["_gid", *seg], [*seg, "_kind", "_key", "spark_grouping_id"], ["_kind", "_key"], [*seg, "_kind", "_key"]]


def test_text_scan_reads_only_the_text(spark):
    p = plan(D.scan_text(table(spark, SF_SMALL, "documents"), "text"))
    assert read_schemas(p) == ["text:string"]
    assert "Join" not in p


def scans_in(p: str) -> int:
    return p.count("FileScan")


def scans(df) -> int:
    return scans_in(plan(df))


def test_samples_and_logs_stay_within_their_scans(spark):
    """Without any static broadcast the samples of a suite shuffle no whole row, and logs read twice."""
    from scrubline.plans.catalog import cleaning_log, raw_rows, run_report, run_summary

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(V.failures(raw_rows(spark, SF_SMALL), V.customer_suite(), "_row_id"))
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
        keyed = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)]
        # the top-k window and the pre-aggregated groupBy of the unique rule, nothing else: row numbers come
        # by a broadcast of one row per split
        assert sorted(x.split("#")[0] for x in keyed) == ["customer_id", "rule_id"]
        assert scans(cleaning_log(raw(spark, SF_SMALL))) == 2
        assert scans(run_report(raw(spark, SF_SMALL))) == 2
        assert scans(run_summary(raw(spark, SF_SMALL))) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
