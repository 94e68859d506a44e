"""SQL entry: the library's expressions as session functions and its tables as views.

``register_functions`` turns column expressions into temporary SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN``), whose bodies Catalyst inlines into the caller's plan: a query
in SQL text is planned like its DataFrame form, without Python and without a shuffle of its own.

    register_functions(spark)
    spark.sql("select scrub_mask_email(scrub_email(email)) from customers")
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import mask as M
from ..operators import pii as D
from ..operators import profile as P
from ..operators import rules as V
from .patterns import DATE_SENTINEL
from .text import date_core, parse_date_core, strip, title

PREFIX = "scrub_"


def sql_text(column: Column, spark: SparkSession, types: str) -> str:
    """A column expression over columns of the types ``types`` as SQL text (literals and names quoted by Spark)."""
    plan = spark.createDataFrame([], types).select(column.alias("x"))._jdf.queryExecution().logical()
    return plan.projectList().apply(0).child().sql()


def function_bodies() -> dict[str, tuple[str, Column | str]]:
    """name -> (result type, body over the parameter ``v``); a body is an expression, or SQL over earlier functions."""
    v = F.col("v")
    return {
        "name": ("string", title(strip(v))),                                                     # C1
        "email": ("string", C.email_expr("v")),                                                  # C2
        "phone": ("string", C.phone_expr("v")),                                                  # C3
        "date_core": ("string", date_core(v)),
        "date_of_core": ("date", parse_date_core(v)),
        "desentinel": ("string", C.desentinel_expr("v")),                                        # C4
        # the core is read by every shape: as a function of its own it is computed once
        "parse_date": ("date", f"{PREFIX}date_of_core({PREFIX}date_core(trim(v)))"),             # F4
        "date": ("string", f"date_format({PREFIX}parse_date({PREFIX}desentinel(v)), 'yyyy-MM-dd')"),  # C5
        "mask_name": ("string", M.name_mask_expr("v")),                                          # M1
        "mask_email": ("string", M.email_mask_expr("v")),                                        # M2
        "mask_phone": ("string", M.phone_mask_expr("v")),                                        # M3
        "mask_address": ("string", M.address_mask_expr("v")),                                    # M4
        "mask_dob": ("string", M.dob_mask_expr("v")),                                            # M5
        "mask_text": ("string", M.mask_text_expr("v")),                                          # M7
        "has_email": ("boolean", F.coalesce(v.rlike(D.EMAIL_PATTERN_LINEAR), F.lit(False))),     # D1
        "has_phone": ("boolean", F.coalesce(v.rlike(D.PHONE_PATTERN), F.lit(False))),            # D2
        "has_address": ("boolean", v.isNotNull() & (F.length(v) > D.ADDRESS_MIN_LENGTH)),        # D3
        "has_dob": ("boolean", F.coalesce(F.lower(v) != DATE_SENTINEL, F.lit(False))),           # D4
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session (again where they exist); their names."""
    made = []
    for name, (kind, body) in function_bodies().items():
        text = body if isinstance(body, str) else sql_text(body, spark, "v string")
        spark.sql(f"create or replace temporary function {PREFIX}{name}(v string) returns {kind} return {text}")
        made.append(PREFIX + name)
    return made


def register_views(spark: SparkSession, raw: DataFrame, prefix: str = "customers", rules=None) -> list[str]:
    """Temporary views of a customer table and what the library makes of it; nothing runs until they are read."""
    rules = rules or V.customer_suite()
    cleaned = C.clean(raw)
    views = {
        "raw": raw, "cleaned": cleaned, "masked": M.mask(cleaned), "completeness": P.completeness(raw),
        "validation_raw": V.evaluate(raw, rules), "validation_cleaned": V.evaluate(cleaned, rules),
        "impact": V.impact(raw, rules), "clean_stats": C.clean_stats(raw), "date_rejects": C.date_rejects(raw, tuple(raw.columns[:1])),
        "pii": D.scan(cleaned),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}_{name}")
    return [f"{prefix}_{name}" for name in views]
