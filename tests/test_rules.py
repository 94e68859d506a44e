"""Rule suite: golden outcomes, row-level flags, samples, gates."""

import os

import pytest
from pyspark.sql import functions as F

from scrubline.operators import clean as C
from scrubline.operators import rules as V
from scrubline.operators.rowid import ROW_ID, number_rows, row_number, with_row_id
from scrubline.plans.catalog import failed_rows

from .conftest import customers

SUITE = V.customer_suite()


def failures_by_rule(df):
    return {r.rule_id: r.unexpected_count for r in V.evaluate(df, SUITE).collect() if not r.success}


def test_golden_raw_failures(golden_raw):
    assert failures_by_rule(golden_raw) == {4: 1, 7: 1, 9: 1, 11: 1, 13: 2, 14: 2}
    s = V.summarize(V.evaluate(golden_raw, SUITE)).first()
    assert (s.successful_expectations, s.unsuccessful_expectations) == (8, 6)
    assert round(s.success_percent, 2) == 57.14
    assert s.success is False


def test_golden_cleaned_failures(golden_raw):
    cleaned = C.clean(golden_raw)
    assert failures_by_rule(cleaned) == {6: 1, 12: 1, 13: 1, 14: 1}
    s = V.summarize(V.evaluate(cleaned, SUITE)).first()
    assert (s.successful_expectations, s.unsuccessful_expectations) == (10, 4)
    assert round(s.success_percent, 2) == 71.43


def test_golden_impact(golden_raw):
    assert V.impact(golden_raw, SUITE).first().impacted_rows == 5
    assert V.impact(C.clean(golden_raw), SUITE).first().impacted_rows == 4


def test_clean_frame_passes(clean_df):
    assert V.summarize(V.evaluate(clean_df, SUITE)).first().success is True


def test_dirty_frame_fails(sample_df):
    assert V.summarize(V.evaluate(sample_df, SUITE)).first().success is False


def test_unique_flags_every_member_and_ignores_nulls(spark, clean_df):
    extra = customers(spark, [
        (2, "Ann", "Lee", None, None, "2000-01-01", None, 1.0, "active", "2024-01-01"),
        (None, "Ann", "Lee", None, None, "2000-01-01", None, 1.0, "active", "2024-01-01"),
        (None, "Ann", "Lee", None, None, "2000-01-01", None, 1.0, "active", "2024-01-01"),
    ])
    df = clean_df.unionByName(extra)
    res = {r.rule_id: r for r in V.evaluate(df, SUITE).collect()}
    assert res[2].unexpected_count == 2          # both rows with id 2, not the null ids
    assert res[1].unexpected_count == 2          # the null ids fail not-null
    flags = V.flag_rows(df, SUITE).where("_u2").select("customer_id").collect()
    assert sorted(r.customer_id for r in flags) == [2, 2]


def test_bounds_and_nan(spark):
    df = customers(spark, [
        (0, "Al", "Bo", None, None, None, None, -1.0, "active", None),
        (1, "Al", "Bo", None, None, None, None, 10000000.0, "active", None),
        (2, "Al", "Bo", None, None, None, None, 10000001.0, "active", None),
        (3, "Al", "Bo", None, None, None, None, float("nan"), "active", None),
    ])
    res = {r.rule_id: r.unexpected_count for r in V.evaluate(df, SUITE).collect()}
    assert res[3] == 1        # id 0
    assert res[10] == 2       # -1 and 10000001; NaN is missing, not out of range
    assert res[9] == 1        # NaN fails not-null


@pytest.mark.parametrize("value,ok", [
    ("2024-01-10", True), ("2024-1-5", True), ("2024-02-30", False), ("2024/01/10", False),
    ("24-01-10", False), ("2024-01-10 ", False), ("[UNKNOWN]", False),
])
def test_date_format_rule(spark, value, ok):
    df = spark.createDataFrame([(value,)], "d string")
    rule = V.R(1, "d", "date_format")
    assert df.select(rule.unexpected(df)).first()[0] is (not ok)


def test_failure_samples_first_k_in_order(golden_raw):
    rows = V.failures(golden_raw, SUITE, "customer_id", k=3).collect()
    dob = [(r.sample_no, r.customer_id, r.value) for r in rows if r.rule_id == 13]
    assert dob == [(1, 4, "1975/05/10"), (2, 6, "invalid_date")]


def test_failure_samples_with_unique_rules_of_several_types(spark):
    """One scan or one more per unique rule: the same rows; hot, null and repeated keys, ties, single keys."""
    rows = [(i, 7 if i % 3 == 0 else None if i % 7 == 0 else i, f"t{i % 400}" if i < 500 else f"u{i}", -i if i % 50 == 1 else i,
             i // 2) for i in range(600, 0, -1)]
    df = spark.createDataFrame(rows, "n long, a long, b string, c long, tie long").repartition(6)
    suite = [V.R(1, "a", "unique"), V.R(2, "b", "unique"), V.R(3, "c", "unique"), V.R(4, "a", "not_null"), V.R(5, "c", "between", min=1)]

    def sample(**how):
        return sorted(map(tuple, V.failures(df, suite, "n", show=("b", "n"), **how).select("rule_id", "sample_no", "n", "b", "value").collect()))

    want = [(1, i, n, f"t{n}", "7") for i, n in ((1, 3), (2, 6), (3, 9))]
    want += [(2, i, i, f"t{i}", f"t{i}") for i in (1, 2, 3)]
    want += [(4, i, n, f"t{n}", None) for i, n in ((1, 7), (2, 14), (3, 28))]
    want += [(5, i, n, f"t{n}", str(-n)) for i, n in ((1, 1), (2, 51), (3, 101))]
    assert sample() == sample(rescan=True) == sorted(want, key=lambda r: r[:2])
    for k in (1, 2, 5):
        assert sample(k=k) == sample(k=k, rescan=True)
    clash = df.withColumnsRenamed({"a": "value", "b": "rule_id", "n": "_ord"})
    names = [V.R(1, "value", "unique"), V.R(2, "rule_id", "unique")]
    assert [r.value for r in V.failures(clash, names, "_ord").orderBy("rule_id", "sample_no").collect()] == ["7"] * 3 + ["t1", "t2", "t3"]
    only = [V.R(3, "c", "unique")]
    assert V.failures(df, only, "n").count() == V.failures(df, only, "n", rescan=True).count() == 0
    tied = [tuple(r) for r in V.failures(df, [V.R(2, "b", "unique")], "tie", k=4).select("tie", "value").orderBy("sample_no").collect()]
    assert tied == [(0, "t1"), (1, "t2"), (1, "t3"), (2, "t4")]


def test_failed_rows_positions(golden_raw):
    got = sorted(map(tuple, failed_rows(with_row_id(golden_raw)).collect()))
    assert got == [(4, 3), (7, 5), (9, 3), (11, 4), (13, 4), (13, 6), (14, 5), (14, 10)]


def test_positions_with_repeated_null_and_unsorted_keys(spark, tmp_dir):
    """Rows are named by their place in the file, whatever their ids are."""
    from scrubline.sources.csv import read_csv
    ids = [30, 10, 20, 5, 1, 5, None, 5, 0]
    path = os.path.join(tmp_dir, "ids.csv")
    with open(path, "w") as f:
        f.write("customer_id,first_name\n" + "".join(f"{'' if i is None else i},Ann\n" for i in ids))
    rows = with_row_id(read_csv(spark, path))
    suite = [V.R(1, "customer_id", "not_null"), V.R(2, "customer_id", "unique"), V.R(3, "customer_id", "between", min=1)]
    got = sorted(map(tuple, failed_rows(rows, suite, k=2).collect()))
    assert got == [(1, 7), (2, 4), (2, 6), (3, 9)]
    many = with_row_id(rows.repartition(5).drop(ROW_ID))
    assert sorted(r.row_number for r in many.select(row_number()).collect()) == list(range(1, 10))


def test_rows_are_numbered_in_file_order(spark, tmp_dir):
    """Files of unlike size in many splits: Spark reads the largest splits first, the numbers follow path and line."""
    from scrubline.sources.csv import read_csv
    folder, at = os.path.join(tmp_dir, "folder"), 0
    os.makedirs(folder)
    for name, n in (("a", 2), ("b", 3000), ("c", 0), ("d", 40), ("e", 1)):
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write("customer_id,first_name\n" + "".join(f"{i},Name{i}\n" for i in range(at, at + n)))
        at += n
    sizes = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        scan = read_csv(spark, folder, places=True)
        assert [r.customer_id for r in scan.limit(2).collect()] != [0, 1]  # a scan does not start with the first file
        direct = number_rows(scan)
        assert direct.where(F.col("customer_id") != F.col(ROW_ID)).count() == 0 and direct.count() == at
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")  # staged, and read in other splits
        staged = os.path.join(tmp_dir, "staged")
        scan.repartition(7).write.parquet(staged)
        rows = number_rows(spark.read.parquet(staged))
        assert rows.where(F.col("customer_id") != F.col(ROW_ID)).count() == 0 and rows.count() == at
        assert rows.columns == ["customer_id", "first_name", ROW_ID]
        wrong = rows.withColumn("first_name", F.when(F.col(ROW_ID).isin(1, 2, 3001, 3042), F.lit(None)).otherwise(F.col("first_name")))
        assert [r.row_number for r in failed_rows(wrong, [V.R(4, "first_name", "not_null")], k=3).orderBy("row_number").collect()] == [2, 3, 3002]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_flags_by_shuffle_equal_flags_by_broadcast(spark, monkeypatch):
    rows = [(i % 7 or None, "Al", "Bo", None, None, None, None, 1.0, "active", None) for i in range(30)] + [
        (99, "Al", "Bo", None, None, None, None, 1.0, "active", None)]
    df = customers(spark, rows)
    a = sorted(map(str, V.flag_rows(df, SUITE).collect()))
    monkeypatch.setattr(V, "BROADCAST_KEYS", 0)
    assert sorted(map(str, V.flag_rows(df, SUITE).collect())) == a


def test_counts_unchanged_by_repartitioning(golden_raw):
    a = sorted(map(tuple, V.evaluate(golden_raw, SUITE).collect()))
    b = sorted(map(tuple, V.evaluate(golden_raw.repartition(7), SUITE).collect()))
    assert a == b


def test_impact_at_most_rows(sample_df):
    r = V.impact(sample_df, SUITE).first()
    assert r.impacted_rows <= r.total_rows


def test_quarantine_split(golden_raw):
    accepted, rejected = V.quarantine_split(golden_raw, SUITE)
    assert accepted.count() + rejected.count() == 10
    got = {r.customer_id: r.failed_rules for r in rejected.collect()}
    assert got == {3: "4,9", 4: "11,13", 5: "7,14", 6: "13", 10: "14"}


def test_quality_gate(golden_raw):
    with pytest.raises(V.QualityGateError):
        V.assert_quality(golden_raw, SUITE, {13: 0.1})
    V.assert_quality(golden_raw, SUITE, {13: 0.5})


def test_missing_column_fails_before_running(spark):
    df = spark.createDataFrame([(1,)], "customer_id long")
    with pytest.raises(ValueError, match="columns missing"):
        V.evaluate(df, SUITE)


def test_cross_field_rule(spark):
    df = spark.createDataFrame([("1990-01-01", "2024-01-01"), ("2024-01-01", "1990-01-01"), ("[UNKNOWN]", "2024-01-01")],
                               "date_of_birth string, created_date string")
    rule = V.R(15, "created_date", "date_order", earlier="date_of_birth")
    assert [r[0] for r in df.select(rule.unexpected(df)).collect()] == [False, True, False]


def test_orders_suite_runs(spark):
    from scrubline.sources.tables import table
    res = V.evaluate(table(spark, "/root/testdata/sf0.001", "orders"), V.orders_suite()).collect()
    assert len(res) == 7
    assert all(r.element_count > 0 for r in res)
    assert F is not None


def test_hot_key_holding_a_third_of_rows(spark):
    """One key holds a third of all rows: counts stay exact and every member is flagged."""
    from scrubline.operators import profile as P
    rows = [(7 if i % 3 == 0 else i, "Al", "Bo", None, None, "2000-01-01", None, 1.0, "active", "2024-01-01")
            for i in range(1, 601)]
    df = customers(spark, rows).repartition(6)
    res = {r.rule_id: r.unexpected_count for r in V.evaluate(df, SUITE).collect()}
    hot = sum(1 for r in rows if r[0] == 7)
    assert res[2] == hot
    assert V.flag_rows(df, SUITE).where("_u2").count() == hot
    assert [(r.customer_id, r.occurrences) for r in P.duplicate_keys(df).collect()] == [(7, hot)]
    assert V.impact(df, SUITE).first().impacted_rows == hot


THREE = [V.R(1, "a", "unique"), V.R(2, "b", "unique"), V.R(3, "c", "unique"), V.R(4, "a", "between", min=0)]


def three_keys(spark, n, seed=0):
    import random
    rnd = random.Random(seed)
    pick = lambda p, *values: rnd.choice(values) if rnd.random() < p else None
    rows = [(pick(0.8, *range(-3, n)), pick(0.9, *[f"k{i}" for i in range(2 * n)]), pick(0.7, *[i / 2 for i in range(n // 2)], float("nan"), 0.0, -0.0))
            for _ in range(n)]
    return spark.createDataFrame(rows, "a long, b string, c double").repartition(4), rows


def brute_three(rows):
    same = [0.0 if r[2] == 0 else "nan" if r[2] is not None and r[2] != r[2] else r[2] for r in rows]
    keys = [[r[0] for r in rows], [r[1] for r in rows], same]
    flags = [tuple(k[i] is not None and k.count(k[i]) > 1 for k in keys) + (rows[i][0] is not None and rows[i][0] < 0,) for i in range(len(rows))]
    return flags


@pytest.mark.parametrize("seed", range(6))
def test_several_unique_rules(spark, seed):
    df, rows = three_keys(spark, 40, seed)
    flags = brute_three(rows)
    got = {r.rule_id: (r.element_count, r.unexpected_count) for r in V.evaluate(df, THREE).collect()}
    assert got == {i + 1: (len(rows), sum(f[i] for f in flags)) for i in range(4)}
    assert tuple(V.impact(df, THREE).first()) == (sum(map(any, flags)), len(rows))
    found = [tuple(r[f"_u{i}"] for i in (1, 2, 3, 4)) for r in V.flag_rows(df, THREE).collect()]
    assert sorted(found) == sorted(flags)
    accepted, rejected = V.quarantine_split(df, THREE)
    assert (accepted.count(), rejected.count()) == (len(rows) - sum(map(any, flags)), sum(map(any, flags)))


def test_several_unique_rules_without_rows_or_duplicates(spark):
    df, _ = three_keys(spark, 40)
    none = df.limit(0)
    assert {(r.rule_id, r.element_count, r.success) for r in V.evaluate(none, THREE).collect()} == {(i, 0, True) for i in (1, 2, 3, 4)}
    assert tuple(V.impact(none, THREE).first()) == (0, 0)
    assert V.flag_rows(none, THREE).count() == 0
    lone = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (None, None, None), (None, None, None)], "a long, b string, c double")
    assert tuple(V.impact(lone, THREE).first()) == (0, 4)
    assert not any(any(r[3:]) for r in V.flag_rows(lone, THREE).collect())


def test_several_unique_rules_share_a_shuffle(spark):
    from .test_plans import plan
    df, _ = three_keys(spark, 40)
    p = plan(V.evaluate(df, THREE))
    keyed = [line for line in p.split("\n") if "Exchange hashpartitioning(rule_id" in line and "_k0" in line]
    assert len(keyed) == 1 and "Join" not in p
    p = plan(V.impact(df, THREE))
    assert "Join" not in p and "Window" not in p and p.count("Exchange hashpartitioning") == 3
