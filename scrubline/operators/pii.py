"""PII detection (D1-D6) on customer columns and on free text.

Detection is a set of conditional counts in one aggregate pass; on free text
each pattern is evaluated once per row (``regexp_count``) and both "rows with a
match" and "number of matches" are derived from that single count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cache import cached_expr
from ..functions.sqltext import Ref, stack_rows
from ..functions.patterns import (
    ADDRESS_MIN_LENGTH, DATE_SENTINEL, EMAIL_PATTERN_LINEAR, PHONE_PATTERN, PY_DIGIT, RISK_LEVELS,
)


def _pct(part, total):
    return part.cast("double") / F.nullif(total, F.lit(0)).cast("double") * F.lit(100.0)


_TYPES = (("email", "email"), ("phone", "phone"), ("address", "address"), ("dob", "date_of_birth"))


def scan(df: DataFrame) -> DataFrame:
    """``(pii_type, column_name, found_rows, total_rows, found_percent)``."""
    return df.agg(*_scan_aggs()).select(_scan_long()).select(*_scan_out())


@cached_expr
def _scan_aggs(prefix: str = "") -> list:
    """The counters over columns named with ``prefix``."""
    email, phone, address, dob = (F.col(prefix + c) for c in ("email", "phone", "address", "date_of_birth"))
    return [
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(email.rlike(EMAIL_PATTERN_LINEAR), F.lit(False))).alias("_email"),
        F.count_if(F.coalesce(phone.rlike(PHONE_PATTERN), F.lit(False))).alias("_phone"),
        F.count_if(address.isNotNull() & (F.length(address) > ADDRESS_MIN_LENGTH)).alias("_address"),
        F.count_if(dob.isNotNull() & (F.lower(dob) != DATE_SENTINEL)).alias("_dob"),
    ]


@cached_expr
def _scan_long() -> Column:
    return stack_rows(("pii_type", "column_name", "found_rows", "total_rows"),
                      tuple((t, c, Ref(f"_{t}"), Ref("_n")) for t, c in _TYPES))


@cached_expr
def _scan_out() -> list:
    return [
        F.col("pii_type"), F.col("column_name"),
        F.col("found_rows").cast("bigint").alias("found_rows"),
        F.col("total_rows").cast("bigint").alias("total_rows"),
        _pct(F.col("found_rows"), F.col("total_rows")).alias("found_percent"),
    ]


def risk_table(spark: SparkSession) -> DataFrame:
    """The static column -> risk level table (seven rows)."""
    return spark.createDataFrame(list(RISK_LEVELS), "column_name string, risk_level string")


def risk(df: DataFrame) -> DataFrame:
    """D6 joined to D1-D5: ``(column_name, risk_level, pii_type, found_rows, total_rows)``.

    The risk table has a fixed seven rows, so broadcasting it is bounded.
    """
    levels = F.broadcast(risk_table(df.sparkSession))
    found = scan(df).select("column_name", "pii_type", "found_rows", "total_rows")
    return levels.join(found, "column_name", "left").select(
        "column_name", "risk_level", "pii_type", "found_rows", "total_rows"
    )


def text_counts(df: DataFrame, text_col: str = "text"):
    """Per-row match counts for both patterns (each regex runs once per row).

    The full patterns only run on texts that can match: an e-mail needs an
    ``@`` and a phone needs a decimal digit.  Both guards are necessary
    conditions of the patterns, so the counts are exactly the unguarded ones.
    """
    return _text_counts(text_col)


@cached_expr
def _text_counts(text_col: str) -> tuple:
    t = F.col(text_col)
    zero = F.lit(0)
    return (
        F.when(t.contains("@"), F.regexp_count(t, F.lit(EMAIL_PATTERN_LINEAR))).otherwise(zero).alias("_ne"),
        F.when(t.rlike(PY_DIGIT), F.regexp_count(t, F.lit(PHONE_PATTERN))).otherwise(zero).alias("_np"),
    )


@cached_expr
def _text_aggs() -> list:
    return [
        F.count(F.lit(1)).alias("total_docs"),
        F.count_if(F.col("_ne") > 0).alias("email_docs"),
        F.coalesce(F.sum("_ne"), F.lit(0)).cast("bigint").alias("email_matches"),
        F.count_if(F.col("_np") > 0).alias("phone_docs"),
        F.coalesce(F.sum("_np"), F.lit(0)).cast("bigint").alias("phone_matches"),
    ]


def scan_text_wide(df: DataFrame, text_col: str = "text", group_cols=()) -> DataFrame:
    """Free-text scan, optionally grouped: ``(*group_cols, total_docs, email_docs,
    email_matches, phone_docs, phone_matches)``.  Grouped scans pre-aggregate per
    task, so a hot group costs one partial row per task."""
    counted = df.select(*group_cols, *text_counts(df, text_col))
    if group_cols:
        return counted.groupBy(*group_cols).agg(*_text_aggs())
    return counted.agg(*_text_aggs())


def scan_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Free-text scan as ``(pii_type, docs_with_match, match_count, total_docs)``."""
    return scan_text_wide(df, text_col).select(_text_long())


@cached_expr
def _text_long() -> Column:
    return stack_rows(("pii_type", "docs_with_match", "match_count", "total_docs"), (
        ("email", Ref("email_docs"), Ref("email_matches"), Ref("total_docs")),
        ("phone", Ref("phone_docs"), Ref("phone_matches"), Ref("total_docs")),
    ))
