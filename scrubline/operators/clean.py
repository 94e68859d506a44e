"""Cleaning / normalisation operators.

Each step is a ``DataFrame -> DataFrame`` projection; chained with
``df.transform`` they collapse into one Project, so the full chain is a single
narrow stage with no shuffle.  Change counters are plain conditional counts
that can be evaluated in the same pass as any other metric (or observed
during the write with ``DataFrame.observe``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (
    DATE_COLUMNS, DATE_SENTINEL, FILL_VALUES, ISO_DATE_PATTERN, NAME_COLUMNS, NON_DIGIT_PATTERN,
)
from ..functions.cache import cached_expr
from ..functions.sqltext import Ref, stack_rows
from ..functions.text import date_core, iso_date, parse_date_core, strip, title


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Replace columns in place, keeping column order (one Project)."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


# --- expressions --------------------------------------------------------------

@cached_expr
def name_expr(c: str) -> Column:
    return title(strip(c))


@cached_expr
def email_expr(c: str = "email") -> Column:
    return F.lower(F.col(c))


@cached_expr
def phone_digits(c: str = "phone") -> Column:
    return F.regexp_replace(F.col(c), NON_DIGIT_PATTERN, "")


@cached_expr
def phone_expr(c: str = "phone") -> Column:
    return _phone_from(phone_digits(c), F.col(c))


def _phone_from(d: Column, original: Column) -> Column:
    formatted = F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4))
    return F.when(F.length(d) == 10, formatted).otherwise(original)


@cached_expr
def desentinel_expr(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(DATE_SENTINEL))


@cached_expr
def date_expr(c: str) -> Column:
    return iso_date(desentinel_expr(c))


# --- operators ----------------------------------------------------------------

def normalize_names(df: DataFrame, columns=NAME_COLUMNS) -> DataFrame:
    """Strip + title-case; null kept."""
    return _replace(df, {c: name_expr(c) for c in columns if c in df.columns})


def normalize_emails(df: DataFrame, column: str = "email") -> DataFrame:
    """Lower-case; skipped when the column is absent."""
    if column not in df.columns:
        return df
    return _replace(df, {column: email_expr(column)})


def normalize_phones(df: DataFrame, column: str = "phone") -> DataFrame:
    """Exactly ten digits -> ``XXX-XXX-XXXX``; anything else unchanged."""
    return _replace(df, {column: phone_expr(column)})


def normalize_dates(df: DataFrame, columns=DATE_COLUMNS) -> DataFrame:
    """C4 + C5: sentinel -> null, mixed layouts -> ``YYYY-MM-DD`` text, unparseable -> null."""
    return _replace(df, {c: date_expr(c) for c in columns if c in df.columns})


def handle_missing(df: DataFrame, fill: dict | None = None) -> DataFrame:
    """Fill placeholders (also replaces NaN in double columns)."""
    fill = {c: v for c, v in (fill or FILL_VALUES).items() if c in df.columns}
    return df.na.fill(fill)


def clean(df: DataFrame, emails: bool = True, fill: bool = True) -> DataFrame:
    """Names -> emails -> phones -> dates -> missing.

    ``emails=False`` is the variant that leaves e-mails untouched;
    ``fill=False`` stops before the missing-value step (C1-C5 only).  Two
    projections in one narrow stage: the first computes the values that the
    second reads several times (phone digits, trimmed date text), so each is
    evaluated once per row instead of once per use.
    """
    cols = tuple(df.columns)
    staged = df.select("*", *_clean_inputs(cols))
    out = staged.select(*_clean_outputs(cols, emails))
    return handle_missing(out) if fill else out


@cached_expr
def _clean_inputs(cols: tuple) -> list:
    out = []
    if "phone" in cols:
        out.append(phone_digits("phone").alias("__digits"))
    out += [date_core(F.trim(desentinel_expr(c))).alias(f"__text_{c}") for c in DATE_COLUMNS if c in cols]
    return out


@cached_expr
def _clean_outputs(cols: tuple, emails: bool) -> list:
    new = {c: name_expr(c) for c in NAME_COLUMNS if c in cols}
    if emails and "email" in cols:
        new["email"] = email_expr()
    if "phone" in cols:
        new["phone"] = _phone_from(F.col("__digits"), F.col("phone"))
    for c in DATE_COLUMNS:
        if c in cols:
            new[c] = F.date_format(parse_date_core(F.col(f"__text_{c}")), "yyyy-MM-dd")
    return [new[c].alias(c) if c in new else F.col(c) for c in cols]


def clean_observed(df: DataFrame, observation, emails: bool = True, fill: dict | None = None) -> DataFrame:
    """C12 with its counters (C7-C10 and the row count) collected by
    ``observe`` in the same pass as the write.

    The cleaned values are computed once, next to the raw ones, below the
    observation; the counters compare the two, and the final projection only
    renames.  Metric names: ``rows``, the ``clean_stats`` names,
    ``missing__<column>`` per fill column and ``unparsed__<column>`` per date column.
    """
    cols = tuple(df.columns)
    fill = {c: v for c, v in (fill or FILL_VALUES).items() if c in cols}
    staged = df.select("*", *_clean_inputs(cols))
    new = _clean_outputs(cols, emails)
    changed = [c for c, e in zip(cols, new) if c in _CLEANED_COLUMNS and (emails or c != "email")]
    both = staged.select(*cols, *(["__digits"] if "phone" in cols else []),
                         *[e.alias(f"__new_{c}") for c, e in zip(cols, new) if c in changed])
    after = {c: F.col(f"__new_{c}") if c in changed else F.col(c) for c in cols}
    dt = dict(df.dtypes)

    def diff(c):
        return F.count_if(_changed(F.col(c), after[c])) if c in changed else F.lit(0).cast("bigint")

    zero = F.lit(0).cast("bigint")
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.length("__digits") == 10) if "phone" in cols else zero).alias("phone_fixes"),
        (diff("phone") if "phone" in cols else zero).alias("phone_changed"),
        sum((F.count_if(desentinel_expr(c).isNotNull() & ~F.col(c).rlike(ISO_DATE_PATTERN))
             for c in DATE_COLUMNS if c in cols), zero).alias("date_fixes"),
        sum((diff(c) for c in NAME_COLUMNS if c in cols), zero).alias("name_fixes"),
        (diff("email") if "email" in cols else zero).alias("email_fixes"),
    ]
    for c in fill:
        v = after[c]
        miss = v.isNull() | F.isnan(v) if dt[c] in ("double", "float") else v.isNull()
        metrics.append(F.count_if(miss).alias(f"missing__{c}"))
    for c in DATE_COLUMNS:
        if c in cols:
            lost = F.coalesce(desentinel_expr(c).isNotNull() & after[c].isNull(), F.lit(False))
            metrics.append(F.count_if(lost).alias(f"unparsed__{c}"))
    observed = both.observe(observation, *metrics)
    return handle_missing(observed.select(*[after[c].alias(c) for c in cols]), fill)


_CLEANED_COLUMNS = set(NAME_COLUMNS) | set(DATE_COLUMNS) | {"email", "phone"}
CHANGED_COLUMNS = _CLEANED_COLUMNS | set(FILL_VALUES)  # columns whose values cleaning may change


# --- values that no layout fits ----------------------------------------------------

def date_rejects(raw: DataFrame, key_columns: tuple = ("customer_id",)) -> DataFrame:
    """The date cells that cleaning sets to missing although they hold text other than the
    sentinel: ``(*key_columns, column_name, value)``, so that no source value is lost."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), unparsed(c).alias("bad"))
             for c in DATE_COLUMNS if c in raw.columns]
    return (raw.select(*key_columns, F.inline(F.array(*cells))).where(F.col("bad")).drop("bad"))


@cached_expr
def unparsed(c: str) -> Column:
    """Text that is neither missing nor the sentinel and that no date layout fits."""
    return F.coalesce(desentinel_expr(c).isNotNull() & date_expr(c).isNull(), F.lit(False))


# --- counters (C7-C10) ----------------------------------------------------------

def _changed(old: Column, new: Column) -> Column:
    return old.isNotNull() & (old != new)


def clean_stat_columns(df: DataFrame) -> list[Column]:
    """Aggregate expressions for the fix counters, evaluated on the *raw* frame."""
    return _clean_stat_columns(tuple(df.columns))


@cached_expr
def _clean_stat_columns(columns: tuple) -> list:
    name_fixes = sum(
        (F.count_if(_changed(F.col(c), name_expr(c))) for c in NAME_COLUMNS if c in columns),
        F.lit(0).cast("bigint"),
    )
    date_fixes = sum(
        (
            F.count_if(desentinel_expr(c).isNotNull() & ~F.col(c).rlike(ISO_DATE_PATTERN))
            for c in DATE_COLUMNS
            if c in columns
        ),
        F.lit(0).cast("bigint"),
    )
    return [
        F.count_if(F.length(phone_digits()) == 10).alias("phone_fixes"),
        F.count_if(_changed(F.col("phone"), phone_expr())).alias("phone_changed"),
        date_fixes.alias("date_fixes"),
        name_fixes.alias("name_fixes"),
        F.count_if(_changed(F.col("email"), email_expr())).alias("email_fixes"),
    ]


def clean_stats(raw: DataFrame) -> DataFrame:
    """C7-C9 as one row, from one aggregate pass over the raw frame."""
    return raw.agg(*clean_stat_columns(raw))


def missing_fill_columns(raw: DataFrame, fill: dict | None = None) -> list[Column]:
    """Per fill column, nulls remaining after C1-C5 (NaN counts as missing)."""
    fill = fill or FILL_VALUES
    return _missing_fill_columns(tuple(raw.dtypes), tuple(fill))


@cached_expr
def _missing_fill_columns(dtypes: tuple, fill: tuple) -> list:
    types = dict(dtypes)
    out = []
    for c in fill:
        if c not in types:
            continue
        if c in DATE_COLUMNS:
            v = date_expr(c)
        elif c in NAME_COLUMNS:
            v = name_expr(c)
        elif c == "phone":
            v = phone_expr(c)
        else:
            v = F.col(c)
        miss = v.isNull()
        if types[c] in ("double", "float"):
            miss = miss | F.isnan(v)
        out.append(F.count_if(miss).alias(c))
    return out


def clean_missing_counts(raw: DataFrame, fill: dict | None = None) -> DataFrame:
    """C10 as a long table ``(ordinal, column_name, fill_value, missing_count, logged_count)``.

    ``logged_count`` reproduces the reference log, which counts a missing
    income twice (once as NaN, once as the text ``nan``).
    """
    fill = {c: v for c, v in (fill or FILL_VALUES).items() if c in raw.columns}
    wide = raw.agg(*missing_fill_columns(raw, fill))
    return wide.select(_missing_long(tuple((c, str(v)) for c, v in fill.items()))).select(*_missing_out())


@cached_expr
def _missing_long(fill: tuple) -> Column:
    return stack_rows(("ordinal", "column_name", "fill_value", "missing_count"),
                      tuple((i, c, v, Ref(c)) for i, (c, v) in enumerate(fill, start=1)))


@cached_expr
def _missing_out() -> list:
    return [
        F.col("ordinal").cast("int").alias("ordinal"),
        F.col("column_name"),
        F.col("fill_value"),
        F.col("missing_count").cast("bigint").alias("missing_count"),
        F.when(F.col("column_name") == "income", F.col("missing_count") * 2)
        .otherwise(F.col("missing_count"))
        .cast("bigint")
        .alias("logged_count"),
    ]

