"""Profiling and PII detection."""

from scrubline.operators import clean as C
from scrubline.operators import pii as D
from scrubline.operators import profile as P


GOLDEN_REPORT = [
    ("COMPLETENESS", "customer_id: 100%"),
    ("COMPLETENESS", "first_name: 90% (1 missing/invalid)"),
    ("COMPLETENESS", "last_name: 90% (1 missing/invalid)"),
    ("COMPLETENESS", "email: 100%"),
    ("COMPLETENESS", "phone: 100%"),
    ("COMPLETENESS", "date_of_birth: 90% (1 missing/invalid)"),
    ("COMPLETENESS", "address: 80% (2 missing/invalid)"),
    ("COMPLETENESS", "income: 90% (1 missing/invalid)"),
    ("COMPLETENESS", "account_status: 90% (1 missing/invalid)"),
    ("COMPLETENESS", "created_date: 90% (1 missing/invalid)"),
    ("DATA TYPES", "customer_id: INT"),
    ("DATA TYPES", "first_name: STRING"),
    ("DATA TYPES", "last_name: STRING"),
    ("DATA TYPES", "email: STRING"),
    ("DATA TYPES", "phone: STRING"),
    ("DATA TYPES", "address: STRING"),
    ("DATA TYPES", "account_status: STRING"),
    ("DATA TYPES", "date_of_birth: STRING  (should be DATE)"),
    ("DATA TYPES", "income: NUMERIC  (detected as Mixed/Object)"),
    ("QUALITY ISSUES", "1. Non-standard Phone Formats, Examples: ['(555) 234-5678', '555.789.0123']"),
    ("QUALITY ISSUES", "2. Inconsistent Date Formats (Slashes detected): ['1975/05/10', '01/15/2024']"),
    ("QUALITY ISSUES", "3. Inconsistent Name Casing: last_name ('wilson')"),
    ("QUALITY ISSUES", "4. Non-standard Email Casing (Uppercase detected)"),
]


def test_golden_profile_report(golden_raw):
    rows = P.report(golden_raw, "customer_id").orderBy("section_no", "item_no").collect()
    assert [(r.section, r.line) for r in rows] == GOLDEN_REPORT


def test_issue_table_and_duplicates(spark, golden_raw):
    dup = golden_raw.unionByName(golden_raw.where("customer_id = 1"))
    iss = {r.check_no: r for r in P.issues(dup, "customer_id").collect()}
    assert iss[6].affected == 2 and iss[6].issue_no == 5
    assert P.duplicate_keys(dup).collect()[0].customer_id == 1


def test_null_keys_count_as_duplicates_in_profile(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "customer_id long")
    assert [r.occurrences for r in P.duplicate_keys(df).collect()] == [2]


def test_invalid_categories_case_insensitive(spark):
    df = spark.createDataFrame([(1, "ACTIVE"), (2, "Closed"), (3, None), (4, "closed"), (5, "Closed")],
                               "customer_id long, account_status string")
    got = sorted(tuple(r) for r in P.invalid_categories(df, "customer_id").collect())
    assert got == [("Closed", 2, 2), ("closed", 4, 1)]


def test_empty_table_gives_null_percent(spark):
    df = spark.createDataFrame([], "customer_id long, first_name string")
    rows = P.completeness(df).collect()
    assert all(r.complete_percent is None and r.total_rows == 0 for r in rows)


def test_pii_counts_golden_cleaned(golden_raw):
    got = {r.pii_type: r.found_rows for r in D.scan(C.clean(golden_raw)).collect()}
    assert got == {"email": 10, "phone": 10, "address": 10, "dob": 10}


def test_pii_counts_raw_golden(golden_raw):
    got = {r.pii_type: r.found_rows for r in D.scan(golden_raw).collect()}
    assert got == {"email": 10, "phone": 10, "address": 8, "dob": 9}


def test_pii_counts_sample(sample_df):
    got = {r.pii_type: r.found_rows for r in D.scan(sample_df).collect()}
    assert got == {"email": 5, "phone": 5, "address": 4, "dob": 4}


def test_risk_table(golden_raw):
    got = {r.column_name: (r.risk_level, r.found_rows) for r in D.risk(C.clean(golden_raw)).collect()}
    assert got["income"] == ("MEDIUM", None)
    assert got["email"] == ("HIGH", 10)
    assert len(got) == 7


def test_text_scan_counts_matches(spark):
    df = spark.createDataFrame([
        (1, "a@b.io and c@d.io, call 555 123 4567"),
        (2, "no personal data"),
        (3, "+44 020 123 4567 then 5551234567"),
        (4, None),
    ], "doc_id long, text string")
    got = {r.pii_type: (r.docs_with_match, r.match_count, r.total_docs) for r in D.scan_text(df).collect()}
    assert got == {"email": (1, 2, 4), "phone": (2, 3, 4)}


def test_every_invalid_category_is_reported(spark):
    """More than ten bad categories, quotes in them, and order keys beyond 2^40."""
    ddl = ("customer_id long, first_name string, last_name string, email string, phone string, date_of_birth string, "
           "address string, income double, account_status string, created_date string")
    names = [f"bad{i}" for i in range(15)] + ["it's", 'say "hi"', "back\\slash"]
    rows = [((1 << 41) + i, None, None, None, None, None, None, None, n, None) for i, n in enumerate(names)]
    rows += [((1 << 41) + 100, None, None, None, None, "1990/01/02", None, None, None, None),
             (1, None, None, None, None, None, None, None, None, "01/15/2024")]
    df = spark.createDataFrame(rows, ddl)
    found = [r for r in P.issues(df, "customer_id").collect()]
    assert sorted(r.examples for r in found if r.check_no == 5) == sorted(map(repr, names))
    assert [r.examples for r in found if r.check_no == 2] == ["['1990/01/02', '01/15/2024']"]  # birth dates first
    lines = [r.line for r in P.report(df, "customer_id").collect()]
    assert sum("Invalid Category Values: " in x for x in lines) == len(names)


def test_long_runs_are_scanned_in_linear_time(spark):
    """A run of a million local-part characters with an @ elsewhere: counted and masked in seconds."""
    import time

    from scrubline.operators import mask as M
    run = "x" * 1_000_000
    df = spark.createDataFrame([(1, run + " a@b.io"), (2, "a@b.ioc@d.io " + run), (3, run + "@")], "doc_id long, text string")
    t = time.time()
    got = {r.pii_type: (r.docs_with_match, r.match_count) for r in D.scan_text(df).collect()}
    masked = {r.doc_id: r.text for r in M.mask_text(df).collect()}
    assert time.time() - t < 60
    assert got["email"] == (2, 2)
    assert masked[1] == run + " [EMAIL]" and masked[3] == run + "@"
