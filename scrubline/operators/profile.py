"""Profiling operators.

Counters are evaluated together in one aggregate pass.  "First-seen" examples
use an explicit order column (the scan's row id or a stable key).  ``issues`` and
``report`` run three jobs over the table when they are called: all counters in
one aggregate (one row), the first non-standard phones (each task keeps the few
that are asked for), and one pre-aggregated ``groupBy(kind, value)`` for slash
dates, invalid categories and repeated keys together, whose defects are written
to the shared folder.  No step collects an unbounded group: every invalid
category is a row of its own, and the full distinct lists are separate tables
(``slash_dates``, ``invalid_categories``, ``duplicate_keys``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import (
    DATE_COLUMNS, DATE_SENTINEL, DECLARED_TYPES, DOB_DRIFT_PATTERN, ISSUE_TITLES, NAME_COLUMNS,
    NONSTANDARD_PHONE_PATTERN, SLASH, UPPERCASE_PATTERN, VALID_STATUSES,
)
from ..functions.cache import cached_expr
from ..functions.sqltext import Ref, stack_rows
from ..functions.text import is_title, py_list_repr, py_repr
from ..session import new_run_dir

_STRING_TYPES = ("string",)
_FLOAT_TYPES = ("double", "float")


def _missing(df: DataFrame, c: str) -> Column:
    v = F.col(c)
    return v.isNull() | F.isnan(v) if dict(df.dtypes)[c] in _FLOAT_TYPES else v.isNull()


def _pct(part: Column, total: Column) -> Column:
    """``part / total * 100`` as a double; null for an empty table."""
    return part.cast("double") / F.nullif(total, F.lit(0)).cast("double") * F.lit(100.0)


def completeness(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, null_count, sentinel_count, missing_count,
    complete_percent, total_rows)``, one row per column, one aggregate pass."""
    dtypes = tuple(df.dtypes)
    return df.agg(*_completeness_aggs(dtypes)).select(_completeness_long(dtypes)).select(*_completeness_out())


@cached_expr
def _completeness_aggs(dtypes: tuple) -> list:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (c, t) in enumerate(dtypes):
        v = F.col(c)
        aggs.append(F.count_if(v.isNull() | F.isnan(v) if t in _FLOAT_TYPES else v.isNull()).alias(f"_null{i}"))
        if t in _STRING_TYPES:
            aggs.append(F.count_if(F.lower(v).contains(DATE_SENTINEL)).alias(f"_sent{i}"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"_sent{i}"))
    return aggs


@cached_expr
def _completeness_long(dtypes: tuple) -> Column:
    return stack_rows(("ordinal", "column_name", "null_count", "sentinel_count", "total_rows"), tuple(
        (i + 1, c, Ref(f"_null{i}"), Ref(f"_sent{i}"), Ref("_n")) for i, (c, _) in enumerate(dtypes)
    ))


@cached_expr
def _completeness_out() -> list:
    missing = F.col("null_count") + F.col("sentinel_count")
    return [
        F.col("ordinal"), F.col("column_name"),
        F.col("null_count").cast("bigint").alias("null_count"),
        F.col("sentinel_count").cast("bigint").alias("sentinel_count"),
        missing.cast("bigint").alias("missing_count"),
        _pct(F.col("total_rows") - missing, F.col("total_rows")).alias("complete_percent"),
        F.col("total_rows").cast("bigint").alias("total_rows"),
    ]


def _drift_flags(df: DataFrame) -> list[Column]:
    dtypes = dict(df.dtypes)
    dob = F.coalesce(F.bool_or(F.col("date_of_birth").rlike(DOB_DRIFT_PATTERN)), F.lit(False))
    inc = F.col("income")
    if dtypes["income"] in _STRING_TYPES:
        bad = inc.isNull() | inc.try_cast("double").isNull()
    else:
        bad = _missing(df, "income")
    return [dob.alias("_dob_drift"), F.coalesce(F.bool_or(bad), F.lit(False)).alias("_income_drift")]


def data_types(df: DataFrame) -> DataFrame:
    """``(ordinal, column_name, reported_type, note)``.

    Declared types for the present columns, then the two drift findings, each
    emitted only when the data shows it (one aggregate pass).
    """
    return _types_from(df.agg(*_drift_flags(df)), df.columns)


def _types_from(flags: DataFrame, columns) -> DataFrame:
    """Type rows from a one-row frame holding ``_dob_drift`` / ``_income_drift``."""
    declared = [(c, t) for c, t in DECLARED_TYPES if c in columns]
    rows = [
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"), F.lit(t).alias("reported_type"),
                 F.lit(None).cast("string").alias("note"), F.lit(True).alias("_show"))
        for i, (c, t) in enumerate(declared)
    ]
    n = len(declared)
    rows.append(F.struct(F.lit(n + 1).alias("ordinal"), F.lit("date_of_birth").alias("column_name"),
                         F.lit("STRING").alias("reported_type"), F.lit("should be DATE").alias("note"),
                         F.col("_dob_drift").alias("_show")))
    rows.append(F.struct(F.lit(n + 2).alias("ordinal"), F.lit("income").alias("column_name"),
                         F.lit("NUMERIC").alias("reported_type"), F.lit("detected as Mixed/Object").alias("note"),
                         F.col("_income_drift").alias("_show")))
    return (
        flags.select(F.inline(F.array(*rows)))
        .where("_show")
        .select(F.col("ordinal").cast("int").alias("ordinal"), "column_name", "reported_type", "note")
    )


# --- distinct-value tables ------------------------------------------------------

def slash_dates(df: DataFrame, order_col: str, columns=DATE_COLUMNS) -> DataFrame:
    """P8 (whole): distinct values containing ``/`` per date column with first-seen
    position and occurrences ``(column_ordinal, column_name, value, first_seen, occurrences)``."""
    present = tuple((i + 1, c) for i, c in enumerate(columns) if c in df.columns)
    cells = stack_rows(("column_ordinal", "column_name", "value"),
                       tuple((i, c, Ref(c)) for i, c in present))
    # one scan: both columns stacked, then the slash filter
    u = df.select(F.col(order_col).alias("_ord"), cells).where(F.col("value").contains(SLASH))
    return u.groupBy("column_ordinal", "column_name", "value").agg(
        F.min("_ord").alias("first_seen"), F.count(F.lit(1)).alias("occurrences")
    ).select(F.col("column_ordinal").cast("int").alias("column_ordinal"), "column_name", "value",
             F.col("first_seen").cast("bigint").alias("first_seen"), "occurrences")


def invalid_categories(df: DataFrame, order_col: str, column: str = "account_status",
                       valid=VALID_STATUSES) -> DataFrame:
    """P11 (whole): distinct non-null values outside the set (case-insensitive)
    ``(value, first_seen, occurrences)``."""
    v = F.col(column)
    return (
        df.where(v.isNotNull() & ~F.lower(v).isin(list(valid)))
        .groupBy(v.alias("value"))
        .agg(F.min(order_col).cast("bigint").alias("first_seen"), F.count(F.lit(1)).alias("occurrences"))
    )


def duplicate_keys(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """P12 (whole): keys held by more than one row; the null key counts too."""
    return (
        df.groupBy(F.col(key).alias(key))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


# --- P7-P12 issue summary ---------------------------------------------------------

_ISSUE_COLUMNS = {
    1: "phone", 2: "date_of_birth,created_date", 3: "first_name,last_name", 4: "email",
    5: "account_status", 6: "customer_id",
}


def _issue_aggs(order_col: str) -> list[Column]:
    """The ungrouped issue counters (and first bad name per column) as aggregates."""
    o = F.col(order_col)
    phone_bad = F.col("phone").rlike(NONSTANDARD_PHONE_PATTERN)
    name_bad = {c: F.col(c).isNotNull() & ~is_title(c) for c in NAME_COLUMNS}
    return [
        F.count_if(F.coalesce(phone_bad, F.lit(False))).alias("c1"),
        sum((F.count_if(F.coalesce(F.col(c).contains(SLASH), F.lit(False))) for c in DATE_COLUMNS),
            F.lit(0).cast("bigint")).alias("c2"),
        *[F.count_if(b).alias(f"c3_{c}") for c, b in name_bad.items()],
        *[F.min_by(F.col(c), F.when(b, o)).alias(f"e3_{c}") for c, b in name_bad.items()],
        F.count_if(F.coalesce(F.col("email").rlike(UPPERCASE_PATTERN), F.lit(False))).alias("c4"),
    ]


def _defects(df: DataFrame, order_col: str, key: str) -> DataFrame:
    """Written table ``(kind, column_ordinal, value, first_seen, occurrences)`` of slash dates (kind 2),
    invalid categories (5) and repeated keys (6), from one scan and one pre-aggregated shuffle."""
    status = F.col("account_status")
    cells = [F.struct(F.lit(2).alias("kind"), F.lit(i + 1).alias("column_ordinal"), F.col(c).alias("value"),
                      F.coalesce(F.col(c).contains(SLASH), F.lit(False)).alias("use"))
             for i, c in enumerate(DATE_COLUMNS)]
    cells.append(F.struct(F.lit(5).alias("kind"), F.lit(0).alias("column_ordinal"), status.alias("value"),
                          F.coalesce(~F.lower(status).isin(list(VALID_STATUSES)), F.lit(False)).alias("use")))
    cells.append(F.struct(F.lit(6).alias("kind"), F.lit(0).alias("column_ordinal"),
                          F.col(key).cast("string").alias("value"), F.lit(True).alias("use")))
    found = (df.select(F.col(order_col).alias("_ord"), F.inline(F.array(*cells))).where("use")
             .groupBy("kind", "column_ordinal", "value")
             .agg(F.min("_ord").cast("bigint").alias("first_seen"), F.count(F.lit(1)).alias("occurrences"))
             .where((F.col("kind") != 6) | (F.col("occurrences") > 1)))
    path = new_run_dir(df.sparkSession, "profile-defects")
    found.write.parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)


def issues(df: DataFrame, order_col: str, key: str = "customer_id", phone_examples: int = 2,
           date_examples: int = 3, counts: dict | None = None) -> DataFrame:
    """``(issue_no, check_no, issue, column_name, affected, examples)``.

    Only issues that are present get rows; ``issue_no`` numbers them in check order,
    ``check_no`` is the fixed position of the check.  Invalid categories (check 5) have
    one row per value, with its number of rows; the other issues have one row each.
    """
    spark = df.sparkSession
    counts = counts or df.agg(*_issue_aggs(order_col)).first().asDict()  # one row of counters
    phones = [r[0] for r in df.where(F.col("phone").rlike(NONSTANDARD_PHONE_PATTERN))
              .orderBy(order_col).limit(phone_examples).select("phone").collect()]
    defects = _defects(df, order_col, key)
    dates = [r[0] for r in defects.where("kind = 2").orderBy("column_ordinal", "first_seen", "value")
             .limit(date_examples).select("value").collect()]
    n_keys, n_categories = defects.agg(F.coalesce(F.sum(F.when(F.col("kind") == 6, F.col("occurrences"))), F.lit(0)),
                                       F.count_if(F.col("kind") == 5)).first()
    names = [f"{c} ('{counts[f'e3_{c}']}')" for c in NAME_COLUMNS if counts[f"c3_{c}"]]
    found = {
        1: (counts["c1"], phones, None), 2: (counts["c2"], dates, None),
        3: (sum(counts[f"c3_{c}"] for c in NAME_COLUMNS), None, ", ".join(names)),
        4: (counts["c4"], None, None), 5: (n_categories, None, None), 6: (n_keys, None, None),
    }
    present = [k for k, v in found.items() if v[0]]
    number = {k: i for i, k in enumerate(present, start=1)}
    rows = [(number[k], k, ISSUE_TITLES[k], _ISSUE_COLUMNS[k], found[k][0], found[k][1], found[k][2]) for k in present if k != 5]
    listed = spark.createDataFrame(rows, "issue_no int, check_no int, issue string, column_name string, affected bigint, "
                                         "shown array<string>, examples string")
    listed = listed.withColumn("examples", F.coalesce("examples", py_list_repr(F.col("shown")))).drop("shown")
    if 5 not in number:
        return listed
    return listed.unionByName(defects.where("kind = 5").select(
        F.lit(number[5]).alias("issue_no"), F.lit(5).alias("check_no"), F.lit(ISSUE_TITLES[5]).alias("issue"),
        F.lit(_ISSUE_COLUMNS[5]).alias("column_name"), F.col("occurrences").alias("affected"),
        py_repr(F.col("value")).alias("examples")))


def _percent_text(p: Column) -> Column:
    """``f"{p:.0f}"``: round half to even on the double, as Python formats it."""
    return F.bround(p, 0).cast("bigint").cast("string")


def report(df: DataFrame, order_col: str, key: str = "customer_id") -> DataFrame:
    """The profile as report lines ``(section_no, section, item_no, column_name, line)``.

    Completeness, type drift and the issue counters come from one aggregate, whose
    single row is fetched when the report is made.  An issue has one line, invalid
    categories one line per value.
    """
    dtypes = tuple(df.dtypes)
    shown = tuple((c, t) for c, t in dtypes if c != order_col or c == key)
    made = df.agg(*_completeness_aggs(shown), *_drift_flags(df), *_issue_aggs(order_col))
    row = made.first()
    wide = df.sparkSession.createDataFrame([row], made.schema)
    comp_rows = wide.select(_completeness_long(shown)).select(*_completeness_out())
    comp = comp_rows.select(
        F.lit(1).alias("section_no"), F.lit("COMPLETENESS").alias("section"),
        F.col("ordinal").alias("item_no"), "column_name",
        F.concat(
            F.col("column_name"), F.lit(": "), _percent_text(F.col("complete_percent")), F.lit("%"),
            F.when(F.col("missing_count") > 0,
                   F.concat(F.lit(" ("), F.col("missing_count").cast("string"), F.lit(" missing/invalid)")))
            .otherwise(F.lit("")),
        ).alias("line"),
    )
    types = _types_from(wide, [c for c, _ in shown]).select(
        F.lit(2).alias("section_no"), F.lit("DATA TYPES").alias("section"),
        F.col("ordinal").alias("item_no"), "column_name",
        F.concat(F.col("column_name"), F.lit(": "), F.col("reported_type"),
                 F.when(F.col("note").isNotNull(), F.concat(F.lit("  ("), F.col("note"), F.lit(")")))
                 .otherwise(F.lit(""))).alias("line"),
    )
    iss = issues(df, order_col, key, counts=row.asDict()).select(
        F.lit(3).alias("section_no"), F.lit("QUALITY ISSUES").alias("section"),
        F.col("issue_no").alias("item_no"), "column_name",
        F.concat(
            F.col("issue_no").cast("string"), F.lit(". "), F.col("issue"),
            F.when(F.col("check_no") == 1, F.concat(F.lit(", Examples: "), F.col("examples")))
            .when(F.col("check_no").isin(2, 3, 5), F.concat(F.lit(": "), F.col("examples")))
            .otherwise(F.lit("")),
        ).alias("line"),
    )
    out = comp.unionByName(types).unionByName(iss)
    return out.select(F.col("section_no").cast("int").alias("section_no"), "section",
                      F.col("item_no").cast("int").alias("item_no"), "column_name", "line")
