"""Masking operators."""

import re

import pytest

from scrubline.operators import clean as C
from scrubline.operators import mask as M

from .conftest import GOLDEN_MASKED, by_id


def test_golden_rows_mask_exactly(golden_raw):
    got = [tuple(r) for r in M.mask(C.clean(golden_raw)).orderBy("customer_id").collect()]
    assert got == GOLDEN_MASKED


def test_names(masker_df):
    out = by_id(M.mask_names(masker_df))
    assert out[1].first_name == "J***"
    assert out[1].last_name == "D***"
    assert out[3].first_name == "[UNKNOWN]"


def test_emails(masker_df):
    out = by_id(M.mask_emails(masker_df))
    assert out[1].email == "j***@gmail.com"
    assert out[2].email is None
    assert out[3].email == "b***@email.com"


@pytest.mark.parametrize("raw,expected", [
    ("john@g.com", "j***@g.com"),
    ("a@b@c.com", "a***@c.com"),
    ("@x.com", "***@x.com"),
    ("nope", "nope"),
    (None, None),
])
def test_email_edge_cases(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "email string")
    assert M.mask_emails(df).first().email == expected


def test_phones(spark, masker_df):
    assert by_id(M.mask_phones(masker_df))[1].phone == "***-***-4567"
    df = spark.createDataFrame([("UNKNOWN",), (None,), ("12345",)], "phone string")
    assert [r.phone for r in M.mask_phones(df).collect()] == ["***-***-****"] * 3


def test_addresses_and_dob(spark, masker_df):
    out = by_id(M.mask(masker_df))
    assert all(r.address == "[MASKED ADDRESS]" for r in out.values())
    assert out[1].date_of_birth == "1985-**-**"
    df = spark.createDataFrame([("[UNKNOWN]",), ("abc",), (None,)], "date_of_birth string")
    assert [r.date_of_birth for r in M.mask_dob(df).collect()] == ["[UNK-**-**", "abc", None]


def test_business_columns_untouched(masker_df):
    before = by_id(masker_df)
    after = by_id(M.mask(masker_df))
    for k in before:
        for c in ("income", "account_status", "created_date", "customer_id"):
            assert after[k][c] == before[k][c]


def test_empty_name_does_not_fail(spark):
    df = spark.createDataFrame([("",)], "first_name string, last_name string".split(",")[0])
    df = df.withColumn("last_name", df.first_name)
    assert M.mask_names(df).first().first_name == "***"


def test_mask_text(spark):
    df = spark.createDataFrame([(1, "mail me at a.b@c.org or call (555) 123-4567 now"), (2, "nothing here"),
                                (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in M.mask_text(df).collect()}
    assert got == {1: "mail me at [EMAIL] or call [PHONE] now", 2: "nothing here", 3: None}


def test_mask_properties_on_driver_table(spark):
    """Over the whole dirty customer table: row count kept, masked e-mails have
    the form ``?***@domain``, the address is constant, phones keep at most four digits."""
    from scrubline.plans.catalog import raw
    r = raw(spark, "/root/testdata/sf0.001")
    m = M.mask(C.clean(r))
    assert m.count() == r.count()
    emails = [x.email for x in m.select("email").collect() if x.email and "@" in x.email]
    assert emails and all(re.fullmatch(r".?\*\*\*@[^@]*", e) for e in emails)
    assert {x.address for x in m.select("address").distinct().collect()} == {"[MASKED ADDRESS]"}
    assert all(sum(ch.isdigit() for ch in x.phone) <= 4 for x in m.select("phone").collect())
