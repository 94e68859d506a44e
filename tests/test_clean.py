"""Cleaning operators: golden rows, fixture cases, counters and properties."""

from pyspark.sql import functions as F

from scrubline.operators import clean as C

from .conftest import GOLDEN_CLEANED, by_id, customers


def test_golden_rows_clean_exactly(golden_raw):
    got = [tuple(r) for r in C.clean(golden_raw).orderBy("customer_id").collect()]
    assert got == GOLDEN_CLEANED


def test_golden_counters(golden_raw):
    s = C.clean_stats(golden_raw).first().asDict()
    assert s == {"phone_fixes": 10, "phone_changed": 3, "date_fixes": 2, "name_fixes": 1, "email_fixes": 1}


def test_golden_missing_counts(golden_raw):
    rows = {r.column_name: (r.missing_count, r.logged_count) for r in C.clean_missing_counts(golden_raw).collect()}
    assert rows == {
        "first_name": (1, 1), "last_name": (1, 1), "address": (2, 2), "date_of_birth": (1, 1),
        "phone": (0, 0), "created_date": (1, 1), "account_status": (1, 1), "income": (1, 2),
    }


def test_names_title_cased(sample_df):
    out = by_id(C.normalize_names(sample_df))
    assert out[2].first_name == "Jane"
    assert out[1].first_name == "John"
    assert out[3].first_name is None          # null kept until the fill step


def test_phones(sample_df):
    out = by_id(C.normalize_phones(sample_df))
    assert out[3].phone == "555-234-5678"
    assert out[4].phone == "555-345-6789"
    assert out[5].phone == "555-456-7890"
    assert out[1].phone == "555-123-4567"


def test_phone_edge_cases(spark):
    df = spark.createDataFrame([("+1 555 123 4567",), ("555-1234",), (None,), ("12345",)], "phone string")
    got = [r.phone for r in C.normalize_phones(df).collect()]
    assert got == ["+1 555 123 4567", "555-1234", None, "12345"]


def test_emails_lowercased(sample_df):
    df = sample_df.withColumn("email", F.when(F.col("customer_id") == 1, "JOHN.DOE@GMAIL.COM").otherwise(F.col("email")))
    assert by_id(C.normalize_emails(df))[1].email == "john.doe@gmail.com"
    assert C.clean_stats(df).first().email_fixes == 1


def test_dates(sample_df):
    out = by_id(C.normalize_dates(sample_df))
    assert out[4].date_of_birth == "1975-05-10"
    assert out[3].date_of_birth is None
    assert out[1].date_of_birth == "1985-03-15"
    assert out[5].created_date == "2024-01-15"


def test_missing_fill(sample_df):
    out = by_id(C.clean(sample_df))
    assert out[3].first_name == "[UNKNOWN]"
    assert out[3].income == 0.0
    assert out[4].account_status == "unknown"
    assert out[3].date_of_birth == "[UNKNOWN]"
    assert out[2].address == "[UNKNOWN]"


def test_nan_income_is_filled(spark):
    df = customers(spark, [(1, "A", "B", None, None, None, None, float("nan"), None, None)])
    assert C.clean(df).first().income == 0.0


def test_email_kept_when_variant_skips_emails(sample_df):
    df = sample_df.withColumn("email", F.upper("email"))
    out = by_id(C.clean(df, emails=False))
    assert out[1].email == "JOHN.DOE@GMAIL.COM"


def test_single_steps_are_idempotent(sample_df):
    for step in (C.normalize_names, C.normalize_emails, C.normalize_phones, C.normalize_dates):
        once = step(sample_df)
        assert sorted(map(tuple, step(once).collect())) == sorted(map(tuple, once.collect())), step.__name__


def test_full_chain_is_not_idempotent(sample_df):
    once = C.clean(sample_df)
    twice = C.clean(once)
    assert by_id(twice)[3].first_name == "[Unknown]"   # the placeholder gets title-cased


def test_row_count_preserved(sample_df):
    assert C.clean(sample_df).count() == sample_df.count()
