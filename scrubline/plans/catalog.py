"""Named queries over the driver tables: one per operator family.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  The
customer queries start from ``dirty_customers`` (a projection of ``customer``).
Its ids are out of order, repeated and null, so whatever needs the order of the
file uses the row numbers of the scan (``raw_rows``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import mask as M
from ..operators import pii as D
from ..operators import profile as P
from ..operators import rules as V
from ..operators.rowid import ROW_ID, number_rows, row_number, with_row_id
from ..operators.segments import profile_by_segment
from ..session import new_run_dir
from ..sources.csv import read_csv, row_counts, write_table
from ..functions.patterns import DATE_COLUMNS, FILL_VALUES
from ..functions.session import register_functions, register_views
from ..functions.sqltext import Expr, Ref, stack_rows
from ..sources.tables import dirty_customers, dirty_from, table

KEY = "customer_id"
GATE = {2: 0.5, 4: 0.05, 7: 0.1, 12: 0.2}  # rule -> share of failing rows at which a run halts


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return dirty_customers(spark, sf)


def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty table with the number of each row in the file order of ``customer``."""
    return dirty_from(with_row_id(table(spark, sf, "customer")), keep=(ROW_ID,))


#: Share of the keys at which the files of ``customer_files`` begin, in order of their names.
FILE_PARTS = (("a", 0.98, 1.0), ("b", 0.1, 0.98), ("c", 0.0, 0.1))


def customer_files(spark: SparkSession, sf: str) -> str:
    """The dirty table as a folder of CSV files of unlike size: the highest keys in few rows first, the bulk, the lowest keys."""
    path = new_run_dir(spark, "files")
    customer = table(spark, sf, "customer")
    rows = dirty_from(customer, keep=("c_custkey",))
    n = (customer.agg(F.max("c_custkey")).first()[0] or 0) + 1
    for name, low, high in FILE_PARTS:
        part = rows.where(F.col("c_custkey").between(int(low * n), int(high * n) - 1)).orderBy("c_custkey").drop("c_custkey")
        write_table(part, f"{path}/{name}", "csv")
    return f"{path}/*"


def file_rows(spark: SparkSession, sf: str) -> DataFrame:
    """These files scanned, staged as a table and numbered in (path, line) order."""
    staged = new_run_dir(spark, "staged")
    write_table(read_csv(spark, customer_files(spark, sf), multiline=True, places=True), staged)
    return number_rows(spark.read.parquet(staged))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(raw(spark, sf))


def masked(spark: SparkSession, sf: str) -> DataFrame:
    return M.mask(cleaned(spark, sf))


# --- sources ------------------------------------------------------------------------

def q_scan_customers(spark, sf):
    return raw(spark, sf)


def q_scan_csv(spark, sf):
    """The dirty table written as CSV by Spark with its columns in another order
    and others among them, then read through the bronze CSV scan (columns by header
    name, all strings, NA tokens, try_cast; line breaks inside quotes)."""
    path = new_run_dir(spark, "csv")
    df = raw(spark, sf)
    mixed = [F.lit("gold, old").alias("tier"), *reversed(df.columns[5:]), F.lit(1).alias("batch"), *df.columns[:5]]
    write_table(df.select(*mixed), path, "csv")
    return read_csv(spark, path, multiline=True, required=tuple(df.columns))


def q_row_counts(spark, sf):
    return row_counts(raw(spark, sf))


# --- cleaning -----------------------------------------------------------------------

def q_clean_names(spark, sf):
    return C.normalize_names(raw(spark, sf)).select(KEY, "first_name", "last_name")


def q_clean_emails(spark, sf):
    return C.normalize_emails(raw(spark, sf)).select(KEY, "email")


def q_clean_phones(spark, sf):
    return C.normalize_phones(raw(spark, sf)).select(KEY, "phone")


def q_clean_dates(spark, sf):
    return C.normalize_dates(raw(spark, sf)).select(KEY, "date_of_birth", "created_date")


def q_clean_missing(spark, sf):
    return C.handle_missing(raw(spark, sf))


def q_clean_full(spark, sf):
    return cleaned(spark, sf)


def q_clean_stats(spark, sf):
    return C.clean_stats(raw(spark, sf))


def q_clean_missing_counts(spark, sf):
    return C.clean_missing_counts(raw(spark, sf))


_NEW = "new__"


def _beside(raw_df: DataFrame) -> DataFrame:
    """Raw columns under their names, cleaned ones beside them as ``new__<name>`` (one projection)."""
    old = "old__"
    both = C.clean(raw_df.select("*", *[F.col(c).alias(old + c) for c in raw_df.columns]))
    return both.select(*[F.col(old + c).alias(c) for c in raw_df.columns],
                       *[F.col(c).alias(_NEW + c) for c in raw_df.columns])


def _counters(raw_df: DataFrame, rules, pii: bool = False) -> DataFrame:
    """One row with every counter of the logs: rows, fixes, missing and unparsed values, failures of
    each rule before (``b<id>``) and after (``a<id>``) cleaning, PII counts of the cleaned table.

    One aggregate over the raw table with the cleaned columns beside it, and one
    pre-aggregated ``groupBy`` per key that must be unique: two scans.
    """
    both = _beside(raw_df)
    types = dict(raw_df.dtypes)
    fill = [c for c in FILL_VALUES if c in raw_df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows"), *C.clean_stat_columns(raw_df),
            *[e.alias(f"_miss_{c}") for c, e in zip(fill, C.missing_fill_columns(raw_df))],
            *[F.count_if(C.unparsed(c)).alias(f"_lost_{c}") for c in DATE_COLUMNS if c in raw_df.columns]]
    keyed = []
    for r in rules:
        after = V.Rule(r.rule_id, _NEW + r.column, r.kind, r.params)
        if r.kind == "unique":
            if r.column in C.CHANGED_COLUMNS:
                raise ValueError(f"{r.column} is changed by cleaning: evaluate its uniqueness on each table")
            keyed.append(V.evaluate(raw_df, [r]).select(F.col("unexpected_count").alias(f"b{r.rule_id}"),
                                                        F.col("unexpected_count").alias(f"a{r.rule_id}")))
        else:
            aggs += [F.count_if(r.unexpected(raw_df)).alias(f"b{r.rule_id}"),
                     F.count_if(V._unexpected(after, types.get(r.column))).alias(f"a{r.rule_id}")]
    if pii:
        aggs += [x for x in D._scan_aggs(_NEW)[1:]]
    out = both.agg(*aggs)
    for k in keyed:  # one-row results: the largest of each column is the one that is there
        out = out.unionByName(k, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def _failed(rules, side: str) -> Expr:
    return Expr(" + ".join(f"cast(`{side}{r.rule_id}` > 0 as bigint)" for r in rules))


def cleaning_log(raw_df: DataFrame, rules=None) -> DataFrame:
    """C11: the cleaning log as ``(ordinal, section, metric, value, status)`` rows: fixes, values
    missing before they were filled, failed rules before and after, size of the output, and
    dates that no layout fits (see ``clean.date_rejects``)."""
    rules = rules or V.customer_suite()
    fill = [c for c in FILL_VALUES if c in raw_df.columns]
    fixes = ("phone_fixes", "date_fixes", "name_fixes", "email_fixes")
    after = _failed(rules, "a")
    rows = [(i, "normalization", m, Ref(m), None) for i, m in enumerate(fixes, start=1)]
    rows += [(4 + i, "missing_values", c, Ref(f"_miss_{c}"), None) for i, c in enumerate(fill, start=1)]
    rows += [(13, "validation", "failures_before", _failed(rules, "b"), None),
             (14, "validation", "failures_after", after, Expr(f"if({after} = 0, 'PASS', 'REVIEW REQUIRED')")),
             (15, "output", "rows", Ref("_rows"), None), (16, "output", "columns", Expr(f"{len(raw_df.columns)}L"), None)]
    rows += [(17 + i, "unparsed", c, Ref(f"_lost_{c}"), None)
             for i, c in enumerate(c for c in DATE_COLUMNS if c in raw_df.columns)]
    return _counters(raw_df, rules).select(stack_rows(("ordinal", "section", "metric", "value", "status"), tuple(rows))).select(
        F.col("ordinal").cast("int").alias("ordinal"), "section", "metric", F.col("value").cast("bigint").alias("value"),
        F.col("status").cast("string").alias("status"))


def q_cleaning_log(spark, sf):
    return cleaning_log(raw(spark, sf))


def q_clean_date_rejects(spark, sf):
    return C.date_rejects(raw(spark, sf), (KEY,))


# --- masking ------------------------------------------------------------------------

def q_mask_names(spark, sf):
    return M.mask_names(cleaned(spark, sf)).select(KEY, "first_name", "last_name")


def q_mask_emails(spark, sf):
    return M.mask_emails(cleaned(spark, sf)).select(KEY, "email")


def q_mask_phones(spark, sf):
    return M.mask_phones(cleaned(spark, sf)).select(KEY, "phone")


def q_mask_addresses(spark, sf):
    return M.mask_addresses(cleaned(spark, sf)).select(KEY, "address")


def q_mask_dob(spark, sf):
    return M.mask_dob(cleaned(spark, sf)).select(KEY, "date_of_birth")


def q_mask_full(spark, sf):
    return masked(spark, sf)


def masked_sample(raw_df: DataFrame, order_col: str = ROW_ID, n: int = 2) -> DataFrame:
    """The first ``n`` rows of the file before and after masking, one row per ``(side, row)``;
    both sides come from the same rows (a top-n, then cleaned and masked)."""
    cols = [c for c in raw_df.columns if c != ROW_ID]
    top = raw_df.orderBy(order_col).limit(n)
    before = top.select(F.lit("before").alias("side"), *cols)
    return before.unionByName(M.mask(C.clean(top)).select(F.lit("after").alias("side"), *cols))


def q_masked_sample(spark, sf):
    return masked_sample(raw_rows(spark, sf))


# --- validation ---------------------------------------------------------------------

def _stages(spark, sf):
    r = raw(spark, sf)
    return (("raw", r), ("cleaned", C.clean(r)))


def q_validate_raw(spark, sf):
    return V.evaluate(raw(spark, sf), V.customer_suite())


def q_validate_clean(spark, sf):
    return V.evaluate(cleaned(spark, sf), V.customer_suite())


def _per_stage(spark, sf, fn) -> DataFrame:
    return _per_table(_stages(spark, sf), fn)


def _per_table(tables, fn) -> DataFrame:
    out = None
    for name, df in tables:
        part = fn(df).select(F.lit(name).alias("stage"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_validate_summary(spark, sf):
    return _per_stage(spark, sf, lambda df: V.summarize(V.evaluate(df, V.customer_suite())))


def q_validate_impact(spark, sf):
    return _per_stage(spark, sf, lambda df: V.impact(df, V.customer_suite()))


def q_validate_failures(spark, sf):
    r = raw_rows(spark, sf)
    return _per_table((("raw", r), ("cleaned", C.clean(r))),
                      lambda df: V.failures(df, V.customer_suite(), ROW_ID, k=3, show=(KEY,)))


def failed_rows(df: DataFrame, rules=None, k: int = 10) -> DataFrame:
    """The numbers of the first ``k`` failing rows of each rule, from the same pass as their values."""
    return V.failures(df, rules or V.customer_suite(), ROW_ID, k=k).select("rule_id", row_number())


def q_validate_failed_rows(spark, sf):
    r = raw_rows(spark, sf)

    return _per_table((("raw", r), ("cleaned", C.clean(r))), failed_rows)


def q_files_failures(spark, sf):
    """V17 over a folder of files: the first failing values in (path, line) order."""
    return V.failures(file_rows(spark, sf), V.customer_suite(), ROW_ID, k=3, show=(KEY,))


def q_files_failed_rows(spark, sf):
    """V18 over a folder of files: "Row n" counts on from file to file."""
    return failed_rows(file_rows(spark, sf))


def q_files_masked_sample(spark, sf):
    """S6 over a folder of files."""
    return masked_sample(file_rows(spark, sf))


def q_validate_orders(spark, sf):
    return V.evaluate(table(spark, sf, "orders"), V.orders_suite())


def q_validate_orders_failures(spark, sf):
    """V17 with a large duplicate-key set: first three failing orders per rule."""
    return V.failures(table(spark, sf, "orders"), V.orders_key_suite(), "o_orderkey", k=3, rescan=True)


def q_validate_events(spark, sf):
    """V15 with three unique rules over keys of three types."""
    return V.evaluate(table(spark, sf, "events"), V.events_suite())


def q_validate_events_impact(spark, sf):
    """V19 with three unique rules."""
    return V.impact(table(spark, sf, "events"), V.events_suite())


def q_quarantine_events(spark, sf):
    """X1 with three unique rules: the rejected events and the rules that they fail."""
    _, rejected = V.quarantine_split(table(spark, sf, "events"), V.events_suite())
    return rejected.select("event_id", "failed_rules", "n_failed")


# --- profiling ----------------------------------------------------------------------

def q_profile_completeness(spark, sf):
    return P.completeness(raw(spark, sf))


def q_profile_completeness_orders(spark, sf):
    return P.completeness(table(spark, sf, "orders"))


def q_profile_types(spark, sf):
    return P.data_types(raw(spark, sf))


def q_profile_issues(spark, sf):
    return P.issues(raw_rows(spark, sf), ROW_ID)


def q_profile_slash_dates(spark, sf):
    return P.slash_dates(raw_rows(spark, sf), ROW_ID)


def q_profile_invalid_status(spark, sf):
    return P.invalid_categories(raw_rows(spark, sf), ROW_ID)


def q_profile_duplicates(spark, sf):
    return P.duplicate_keys(raw(spark, sf), KEY)


def q_profile_duplicates_orders(spark, sf):
    return P.duplicate_keys(table(spark, sf, "orders"), "o_custkey")


def q_profile_by_segment(spark, sf):
    return profile_by_segment(raw(spark, sf))


def q_profile_report(spark, sf):
    return P.report(raw_rows(spark, sf), ROW_ID)


# --- PII ----------------------------------------------------------------------------

def q_pii_scan(spark, sf):
    return D.scan(cleaned(spark, sf))


def q_pii_scan_raw(spark, sf):
    return D.scan(raw(spark, sf))


def q_pii_risk(spark, sf):
    return D.risk(cleaned(spark, sf))


def q_pii_scan_documents(spark, sf):
    return D.scan_text(table(spark, sf, "documents"), "text")


def q_pii_scan_by_source(spark, sf):
    return D.scan_text_wide(table(spark, sf, "documents"), "text", ("lang", "source"))


def q_pii_scan_conversations(spark, sf):
    return D.scan_text_wide(table(spark, sf, "conversations"), "text", ("role",))


def q_pii_scan_pages(spark, sf):
    return D.scan_text(table(spark, sf, "pages"), "html")


def q_mask_documents(spark, sf):
    return M.mask_text(table(spark, sf, "documents").select("doc_id", "text"), "text")


# --- pipeline-level -----------------------------------------------------------------

def run_report(raw_df: DataFrame, rules=None) -> DataFrame:
    """O2: stage metrics ``(ordinal, stage, metric, value)`` of a run over ``raw_df``, without its sinks
    (the job reports the rows that it really wrote, see ``pipeline``)."""
    rules = rules or V.customer_suite()
    fill = [c for c in FILL_VALUES if c in raw_df.columns]
    missing = Expr(" + ".join(f"`_miss_{c}`" for c in fill) or "0L")
    return _counters(raw_df, rules, pii=True).select(stack_rows(("ordinal", "stage", "metric", "value"), (
        (1, "LOAD", "rows", Ref("_rows")),
        (2, "LOAD", "columns", Expr(f"{len(raw_df.columns)}L")),
        (3, "VALIDATE (RAW)", "failures", _failed(rules, "b")),
        (4, "CLEAN", "phone_fixes", Ref("phone_fixes")),
        (5, "CLEAN", "email_fixes", Ref("email_fixes")),
        (6, "CLEAN", "date_fixes", Ref("date_fixes")),
        (7, "CLEAN", "name_fixes", Ref("name_fixes")),
        (8, "CLEAN", "missing_fills", missing),
        (9, "VALIDATE (CLEANED)", "failures", _failed(rules, "a")),
        (10, "DETECT PII", "emails", Ref("_email")),
        (11, "DETECT PII", "dobs", Ref("_dob")),
        (12, "SAVE", "masked_rows", Ref("_rows")),
    ))).select(F.col("ordinal").cast("int").alias("ordinal"), "stage", "metric", F.col("value").cast("bigint").alias("value"))


def q_run_report(spark, sf):
    return run_report(raw(spark, sf))


def run_summary(raw_df: DataFrame, rules=None) -> DataFrame:
    """O3: ``(input_rows, output_rows, quality_status, execution_status)`` of a run over ``raw_df``.

    Cleaning and masking are projections, so one count holds for both ends here; the job
    reports the rows that it really wrote (see ``pipeline``).  Two scans.
    """
    rules = rules or V.customer_suite()
    status = F.expr(f"if({_failed(rules, 'a')} = 0, 'PASS', 'FAIL')")
    return _counters(raw_df, rules).select(
        F.col("_rows").cast("bigint").alias("input_rows"), F.col("_rows").cast("bigint").alias("output_rows"),
        status.alias("quality_status"), F.lit("SUCCESS").alias("execution_status"))


def q_run_summary(spark, sf):
    return run_summary(raw(spark, sf))


def q_published_masked(spark, sf):
    """The masked table of a whole run as readers find it by the manifest."""
    from ..sources import publish
    from .pipeline import run_pipeline
    out = new_run_dir(spark, "published")
    run_pipeline(spark, raw(spark, sf), out, fail_fast=True)
    return publish.read(spark, out, "masked")


def q_quarantine(spark, sf):
    _, rejected = V.quarantine_split(raw(spark, sf), V.customer_suite())
    return rejected


def q_cross_field(spark, sf):
    """X2 on the cleaned table: every row, whether both dates are present
    (``checked``) and whether ``created_date`` is not after ``date_of_birth``."""
    c = cleaned(spark, sf)
    rule = V.R(15, "created_date", "date_order", earlier="date_of_birth")
    both = F.try_to_date("date_of_birth", "yyyy-M-d").isNotNull() & F.try_to_date("created_date", "yyyy-M-d").isNotNull()
    return c.select(KEY, "date_of_birth", "created_date", both.alias("checked"), rule.unexpected(c).alias("violated"))


def q_quality_gate(spark, sf):
    """X4 on the raw table: a few critical rules, some of which halt the job."""
    return V.gate(V.evaluate(raw(spark, sf), V.customer_suite()), GATE)


#: The masked table, the rule results and the completeness of the raw table in nothing but SQL.
MASK_SQL = """
select customer_id, scrub_mask_name(coalesce(scrub_name(first_name), '[UNKNOWN]')) as first_name,
  scrub_mask_name(coalesce(scrub_name(last_name), '[UNKNOWN]')) as last_name, scrub_mask_email(scrub_email(email)) as email,
  scrub_mask_phone(coalesce(scrub_phone(phone), 'UNKNOWN')) as phone,
  scrub_mask_dob(coalesce(scrub_date(date_of_birth), '[UNKNOWN]')) as date_of_birth, scrub_mask_address(address) as address,
  coalesce(nanvl(income, 0D), 0D) as income, coalesce(account_status, 'unknown') as account_status,
  coalesce(scrub_date(created_date), '[UNKNOWN]') as created_date
from customers_raw
"""
REPORT_SQL = """
select r.rule_id, r.column_name, r.unexpected_count as before, c.unexpected_count as after, m.missing_count
from customers_validation_raw r join customers_validation_cleaned c on r.rule_id = c.rule_id
left join customers_completeness m on m.column_name = r.column_name
where r.unexpected_count > 0 or c.unexpected_count > 0
"""


def _sql_session(spark: SparkSession, sf: str) -> None:
    register_functions(spark)
    register_views(spark, raw(spark, sf))


def q_sql_mask_full(spark, sf):
    _sql_session(spark, sf)
    return spark.sql(MASK_SQL)


def q_sql_rule_report(spark, sf):
    _sql_session(spark, sf)
    return spark.sql(REPORT_SQL)


def q_stream_mask_customers(spark, sf):
    from ..streaming.incremental import stream_masked_customers
    return stream_masked_customers(spark, sf)


def q_stream_duplicate_keys(spark, sf):
    from ..streaming.incremental import stream_duplicate_keys
    return stream_duplicate_keys(spark, sf, "orders", "o_custkey")


def q_stream_unique_events(spark, sf):
    from ..streaming.unique import stream_unique_events
    return stream_unique_events(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
