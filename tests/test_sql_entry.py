"""SQL functions and views: the DataFrame expressions in SQL text."""

import pytest

from scrubline.functions.session import register_functions, register_views
from scrubline.operators import clean as C
from scrubline.operators import mask as M
from scrubline.plans.catalog import MASK_SQL, masked, raw

from .conftest import GOLDEN_MASKED, SF_SMALL
from .test_plans import plan

VALUES = ["  o'brien  mary-jane ", "O'BRIEN", "", None, "USER@Example.COM", "a@b@c.com", "no mail", "(555) 123-4567", "555.123.4567 x", "invalid_date",
          "Monday, January 15, 2024", "15.01.2024", "2024-01-15 10:30", "call 555-123-4567 or mail x.y@z.org", "back\\slash 'q' \"d\"", "$1 \\1", "INVALID_DATE"]


@pytest.fixture(scope="module")
def ready(spark):
    register_functions(spark)
    register_functions(spark)  # again does no harm
    return spark


def test_functions_equal_the_expressions(ready):
    df = ready.createDataFrame([(v,) for v in VALUES], "text string")
    df.createOrReplaceTempView("texts")
    for name, expr in (("name", C.name_expr("text")), ("email", C.email_expr("text")), ("phone", C.phone_expr("text")), ("date", C.date_expr("text")),
                       ("desentinel", C.desentinel_expr("text")), ("mask_name", M.name_mask_expr("text")), ("mask_email", M.email_mask_expr("text")),
                       ("mask_phone", M.phone_mask_expr("text")), ("mask_address", M.address_mask_expr("text")), ("mask_dob", M.dob_mask_expr("text")),
                       ("mask_text", M.mask_text_expr("text"))):
        got = ready.sql(f"select text, scrub_{name}(text) as x from texts").collect()
        assert sorted(map(str, got)) == sorted(map(str, df.select("text", expr.alias("x")).collect())), name
    found = ready.sql("select text from texts where scrub_has_email(text) and scrub_has_phone(text)").collect()
    assert [r.text for r in found] == [VALUES[13]]


def test_masked_table_in_sql(ready, golden_raw):
    register_views(ready, golden_raw)
    assert sorted(map(tuple, ready.sql(MASK_SQL).select(*golden_raw.columns).collect())) == GOLDEN_MASKED
    assert ready.table("customers_validation_raw").where("unexpected_count > 0").count() == 6
    register_views(ready, raw(ready, SF_SMALL))
    assert sorted(map(str, ready.sql(MASK_SQL).select(*golden_raw.columns).collect())) == sorted(map(str, masked(ready, SF_SMALL).collect()))


def test_plan_is_native_and_narrow(ready):
    register_views(ready, raw(ready, SF_SMALL))
    p = plan(ready.sql(MASK_SQL))
    assert "Exchange" not in p and "Python" not in p and "ArrowEval" not in p and p.count("FileScan") == 1
    assert p.count("dayofweek") == 0 and p.count("(?:mon|tue|") <= 4  # the date core is computed once per column, not per shape
