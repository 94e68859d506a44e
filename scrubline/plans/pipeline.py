"""End-to-end job (O1-O4): load -> validate -> profile -> clean -> validate ->
detect PII -> mask -> save, with report tables.

Execution plan
--------------
* A CSV source is parsed once into a Parquet table in the shared folder
  (``spark.checkpoint.dir``) with the place of each row in its files, malformed rows and cells
  that did not fit their type are counted there, and every later stage reads
  columnar data; a lost executor only recomputes from that table.
* With critical rules the raw table is validated first, and the gate decides before
  any table of the run is written.
* Cleaning is one projection written once (sink S4).  Its fix counters and the
  per-column nulls before the fill step are collected with ``DataFrame.observe``
  during that write; the rows that masking wrote are observed in the same way.
* Each metric is computed once: the two validation results are written, and
  the summary, cleaning log, run report and run summary are assembled from
  those small results and the observed counters (bounded rows on the driver).
* CSV is an export: masking, PII scan and re-validation read the Parquet copy.
* The tables of a run are published by one manifest after the last of them is written.
* Independent actions of a phase are submitted together from a small thread
  pool, so Spark runs them as concurrent jobs instead of one after another.
"""

from __future__ import annotations

import os
import time
import traceback
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import mask as M
from ..operators import pii as D
from ..operators import profile as P
from ..operators import rules as V
from ..operators.rowid import ROW_ID, number_rows, with_row_id
from ..session import new_run_dir, use_jit_safe_codegen
from ..sources import publish
from ..sources.csv import read_csv, write_table
from .catalog import masked_sample


@dataclass
class PipelineResult:
    status: str
    cleaned: DataFrame | None = None
    masked: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)
    fix_counters: dict = field(default_factory=dict)
    error: str | None = None
    timings: dict = field(default_factory=dict)   # seconds per written table
    run_dir: str | None = None                    # where this run wrote its tables
    published: int | None = None                  # number of its manifest (see sources.publish)


def _concurrently(tasks: dict) -> dict:
    """Run independent actions as concurrent Spark jobs; results by name.
    The first failure is raised after all submitted jobs have finished."""
    with ThreadPoolExecutor(max_workers=min(4, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def _summary(results: DataFrame):
    """V16 of a written (tiny) V15 table, as one driver-side Row."""
    return V.summarize(results).first()


def run_pipeline(
    spark: SparkSession,
    source: DataFrame | str,
    out_dir: str,
    order_col: str | None = None,
    rules: list | None = None,
    output_format: str = "parquet",
    critical: dict[int, float] | None = None,
    fail_fast: bool = False,
    gate_on: str = "raw",
    multiline: bool = False,
    tune_codegen: bool = True,
) -> PipelineResult:
    """Run the whole job.  ``source`` is a DataFrame or a CSV path.

    ``order_col`` orders examples and samples (default: the order of the rows in the
    source).  ``critical`` maps rule ids to the share of rows at which the job halts
    (X4), judged on the raw table before anything is written, or with ``gate_on="cleaned"``
    on the cleaned one before the masked output.  ``multiline`` reads CSV values with line
    breaks (each file is then one split).  ``tune_codegen=False`` leaves the session's code
    generation limit alone.  Unless ``fail_fast``, any failure is captured as a ``FAILED``
    status and a run report is still written (O4).

    The tables go to a folder of the run and are published together at its end: readers
    (``publish.read``) see the former run until then, and for good if this one fails.
    """
    rules = rules or V.customer_suite()
    if tune_codegen:
        use_jit_safe_codegen(spark)
    reports: dict[str, DataFrame] = {}
    run, run_dir = publish.new_run(out_dir)
    rep_dir = os.path.join(run_dir, "reports")
    tables: dict[str, tuple] = {}  # what the manifest will name
    timings: dict[str, float] = {}

    def stage(name: str, df: DataFrame, path: str) -> DataFrame:
        t = time.perf_counter()
        write_table(df, path)
        timings[name] = round(time.perf_counter() - t, 3)
        return spark.read.schema(df.schema).parquet(path)

    def report(name: str, df: DataFrame) -> DataFrame:
        reports[name] = stage(name, df, os.path.join(rep_dir, name))
        tables[name] = (f"runs/{run}/reports/{name}", "parquet", df.schema)
        return reports[name]

    def output(name: str, df: DataFrame) -> DataFrame:
        """A result table: Parquet, or a Parquet copy in the shared folder and its CSV export."""
        tables[name] = (f"runs/{run}/{name}", output_format, df.schema)
        if output_format == "parquet":
            return stage(name, df, os.path.join(run_dir, name))
        copy = stage(name, df, new_run_dir(spark, name))
        write_table(copy, os.path.join(run_dir, name), output_format)
        return copy

    try:
        # a CSV source is parsed once; a DataFrame source is used as given (stage it yourself if
        # its plan is expensive)
        load_rows = []
        if isinstance(source, str):
            parsed = read_csv(spark, source, keep_bronze=True, multiline=multiline, corrupt_column="_corrupt", places=True)
            staged = stage("raw", parsed, new_run_dir(spark, "raw"))
            bronze = [c for c in staged.columns if c.endswith("__raw")]
            bad = staged.agg(F.count("_corrupt").alias("malformed_rows"),
                             *[F.count_if(F.col(c).isNotNull() & F.col(c.removesuffix("__raw")).isNull())
                               .alias(f"unreadable_{c.removesuffix('__raw')}") for c in bronze]).first()
            load_rows = [(k, int(v)) for k, v in bad.asDict().items()]
            rows = number_rows(staged.drop("_corrupt", *bronze))
        else:
            rows = with_row_id(source)
        raw = rows.drop(ROW_ID)
        order = order_col or ROW_ID

        def validated() -> DataFrame:
            return V.evaluate(raw, rules)

        val_raw = None
        if critical and gate_on == "raw":  # X4: halt before any table of the run is written
            checked = validated().collect()  # one row per rule
            V.check_gate(checked, critical)
            val_raw = report("validation_raw", spark.createDataFrame(checked, validated().schema))

        # independent actions of one phase run as concurrent Spark jobs
        cleaning, masking = Observation("cleaning"), Observation("masking")
        todo = {
            "profile_report": lambda: report("profile_report", P.report(rows, order)),
            "date_rejects": lambda: report("date_rejects", C.date_rejects(raw, tuple(raw.columns[:1]))),
            "cleaned": lambda: output("cleaned", C.clean_observed(raw, cleaning)),
        }
        if val_raw is None:
            todo["validation_raw"] = lambda: report("validation_raw", validated())
        done = _concurrently(todo)
        val_raw, cleaned = val_raw or done["validation_raw"], done["cleaned"]
        metrics = dict(cleaning.get)
        n_clean = metrics.pop("rows")

        def part(prefix: str) -> dict:
            return {k.removeprefix(prefix): v for k, v in metrics.items() if k.startswith(prefix)}

        nulls, lost = part("missing__"), part("unparsed__")
        fixes = {k: v for k, v in metrics.items() if "__" not in k}

        done = _concurrently({
            "validation_cleaned": lambda: report("validation_cleaned", V.evaluate(cleaned, rules)),
            "validation_failures": lambda: report("validation_failures", V.failures(
                C.clean(rows), rules, order, show=tuple(dict.fromkeys((*raw.columns[:1], order))))),
            "pii_report": lambda: report("pii_report", D.risk(cleaned)),
        })
        val_clean, pii = done["validation_cleaned"], done["pii_report"]
        if critical and gate_on == "cleaned":
            V.check_gate(val_clean.collect(), critical)
        before, after = _summary(val_raw), _summary(val_clean)

        masked = output("masked", M.mask(cleaned).observe(masking, F.count(F.lit(1)).alias("rows")))
        n_masked = masking.get["rows"]
        n_raw = val_raw.agg(F.max("element_count")).first()[0]

        fills = list(nulls.items())
        log_rows = [(i, "normalization", m, int(fixes[m]), None)
                    for i, m in enumerate(("phone_fixes", "date_fixes", "name_fixes", "email_fixes"), start=1)]
        log_rows += [(4 + i, "missing_values", c, int(v), None) for i, (c, v) in enumerate(fills, start=1)]
        log_rows += [
            (13, "validation", "failures_before", int(before.unsuccessful_expectations), None),
            (14, "validation", "failures_after", int(after.unsuccessful_expectations),
             "PASS" if after.unsuccessful_expectations == 0 else "REVIEW REQUIRED"),
            (15, "output", "rows", int(n_clean), None),
            (16, "output", "columns", len(cleaned.columns), None),
        ]
        log_rows += [(17 + i, "unparsed", c, int(v), None) for i, (c, v) in enumerate(lost.items())]
        log_rows += [(20 + i, "load", c, v, None) for i, (c, v) in enumerate(load_rows)]
        found = {r.pii_type: r.found_rows for r in pii.collect()}  # seven rows
        run_rows = [
            (1, "LOAD", "rows", int(n_raw)), (2, "LOAD", "columns", len(raw.columns)),
            (3, "VALIDATE (RAW)", "failures", int(before.unsuccessful_expectations)),
            (4, "CLEAN", "phone_fixes", int(fixes["phone_fixes"])),
            (5, "CLEAN", "email_fixes", int(fixes["email_fixes"])),
            (6, "CLEAN", "date_fixes", int(fixes["date_fixes"])),
            (7, "CLEAN", "name_fixes", int(fixes["name_fixes"])),
            (8, "CLEAN", "missing_fills", int(sum(v for _, v in fills))),
            (9, "VALIDATE (CLEANED)", "failures", int(after.unsuccessful_expectations)),
            (10, "DETECT PII", "emails", found.get("email")),
            (11, "DETECT PII", "dobs", found.get("dob")),
            (12, "SAVE", "masked_rows", int(n_masked)),  # counted while they were written
        ]
        run_rows += [(13 + i, "LOAD", c, v) for i, (c, v) in enumerate(load_rows)]
        summary_rows = [("raw", *before), ("cleaned", *after)]
        _concurrently({
            "masked_sample": lambda: report("masked_sample", masked_sample(rows, order)),
            "validation_summary": lambda: report("validation_summary", spark.createDataFrame(
                summary_rows,
                "stage string, evaluated_expectations bigint, successful_expectations bigint, "
                "unsuccessful_expectations bigint, success_percent double, success boolean")),
            "cleaning_log": lambda: report("cleaning_log", spark.createDataFrame(
                log_rows, "ordinal int, section string, metric string, value bigint, status string")),
            "run_report": lambda: report("run_report", spark.createDataFrame(
                run_rows, "ordinal int, stage string, metric string, value bigint")),
            "run_summary": lambda: report("run_summary", spark.createDataFrame(
                [(int(n_raw), int(n_masked), "PASS" if after.success else "FAIL", "SUCCESS")],
                "input_rows bigint, output_rows bigint, quality_status string, execution_status string")),
        })
        number = publish.commit(spark, out_dir, run, tables)
        return PipelineResult("SUCCESS", cleaned, masked, reports, fixes, timings=timings, run_dir=run_dir, published=number)
    except Exception as e:  # O4: capture, report, do not raise
        if fail_fast:
            raise
        msg = f"{type(e).__name__}: {e}"
        failed = spark.createDataFrame(
            [(1, "FAILED", "error", msg, traceback.format_exc())],
            "ordinal int, stage string, metric string, message string, detail string",
        )
        write_table(failed, os.path.join(rep_dir, "run_report"))
        return PipelineResult("FAILED", reports={"run_report": failed}, error=msg, run_dir=run_dir)
