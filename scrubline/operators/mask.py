"""Masking operators (M1-M7).

Spark's built-in ``mask()`` replaces characters class by class and cannot
express these shapes, so each one is a small ``when``/``concat`` expression.
All of them are total functions: malformed input never raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (
    ADDRESS_MASK, DOB_MASK_SUFFIX, EMAIL_MASK_INFIX, EMAIL_PATTERN_LINEAR, EMAIL_TEXT_TOKEN,
    FORMATTED_PHONE_PATTERN, NAME_COLUMNS, NAME_MASK_SUFFIX, NAME_PLACEHOLDER, PHONE_MASK_FULL,
    PHONE_MASK_PREFIX, PHONE_PATTERN, PHONE_TEXT_TOKEN, PY_DIGIT,
)

ANY_DIGIT = PY_DIGIT  # a phone match needs at least one decimal digit
from ..functions.cache import cached_expr
from .clean import _replace


@cached_expr
def name_mask_expr(c: str) -> Column:
    v = F.col(c)
    return F.when(v.isNull() | (v == NAME_PLACEHOLDER), v).otherwise(
        F.concat(F.substring(v, 1, 1), F.lit(NAME_MASK_SUFFIX))
    )


@cached_expr
def email_mask_expr(c: str = "email") -> Column:
    v = F.col(c)
    masked = F.concat(
        F.substring(F.substring_index(v, "@", 1), 1, 1),
        F.lit(EMAIL_MASK_INFIX),
        F.substring_index(v, "@", -1),
    )
    return F.when(v.contains("@"), masked).otherwise(v)


@cached_expr
def phone_mask_expr(c: str = "phone") -> Column:
    v = F.col(c)
    return F.when(
        v.rlike(FORMATTED_PHONE_PATTERN), F.concat(F.lit(PHONE_MASK_PREFIX), F.substring(v, -4, 4))
    ).otherwise(F.lit(PHONE_MASK_FULL))


@cached_expr
def address_mask_expr(c: str = "address") -> Column:
    return F.lit(ADDRESS_MASK)


@cached_expr
def dob_mask_expr(c: str = "date_of_birth") -> Column:
    v = F.col(c)
    return F.when(F.length(v) >= 4, F.concat(F.substring(v, 1, 4), F.lit(DOB_MASK_SUFFIX))).otherwise(v)


def mask_names(df: DataFrame, columns=NAME_COLUMNS) -> DataFrame:
    """M1: first character + ``***``; null and the placeholder are kept."""
    return _replace(df, {c: name_mask_expr(c) for c in columns})


def mask_emails(df: DataFrame, column: str = "email") -> DataFrame:
    """M2: first character of the local part + ``***@`` + domain; no ``@`` -> unchanged."""
    return _replace(df, {column: email_mask_expr(column)})


def mask_phones(df: DataFrame, column: str = "phone") -> DataFrame:
    """M3: formatted phone -> ``***-***-`` + last four; anything else (null too) fully masked."""
    return _replace(df, {column: phone_mask_expr(column)})


def mask_addresses(df: DataFrame, column: str = "address") -> DataFrame:
    """M4: constant, nulls included."""
    return _replace(df, {column: address_mask_expr(column)})


def mask_dob(df: DataFrame, column: str = "date_of_birth") -> DataFrame:
    """M5: year + ``-**-**`` when at least four characters long."""
    return _replace(df, {column: dob_mask_expr(column)})


def mask(df: DataFrame) -> DataFrame:
    """M6: M1-M5 as one projection; income, status and created_date untouched."""
    new = {c: name_mask_expr(c) for c in NAME_COLUMNS if c in df.columns}
    for c, fn in (
        ("email", email_mask_expr), ("phone", phone_mask_expr),
        ("address", address_mask_expr), ("date_of_birth", dob_mask_expr),
    ):
        if c in df.columns:
            new[c] = fn(c)
    return _replace(df, new)


@cached_expr
def mask_text_expr(c: str = "text") -> Column:
    """M7: e-mail then phone matches inside free text replaced by tokens.

    Each replacement only runs on texts that can match at all (an ``@`` for
    e-mails, a decimal digit for phones); for the others it is the identity,
    so the guard changes cost, never results.
    """
    v = F.col(c)
    t = F.when(v.contains("@"), F.regexp_replace(v, EMAIL_PATTERN_LINEAR, EMAIL_TEXT_TOKEN)).otherwise(v)
    return F.when(t.rlike(ANY_DIGIT), F.regexp_replace(t, PHONE_PATTERN, PHONE_TEXT_TOKEN)).otherwise(t)


def mask_text(df: DataFrame, column: str = "text") -> DataFrame:
    return _replace(df, {column: mask_text_expr(column)})
