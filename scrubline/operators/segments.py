"""The profile per segment (P1-P12 by account status, year of creation and their totals).

Every check of the profile is a yes or no per row, so the profile of all segments is
one aggregate over grouping sets.  Repeated keys need the key as well: a row goes once into the
counters (without key) and once into the key counts (without counters), both in one
pre-aggregated ``groupBy``, so the table is read once.  The counters are then few rows; of the keys
only those that are held more than once go on, and are counted anew per grouping set, because a key
may repeat in the whole table and not within a segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import (
    DATE_COLUMNS, DATE_SENTINEL, DOB_DRIFT_PATTERN, NAME_COLUMNS, NONSTANDARD_PHONE_PATTERN, SLASH, UPPERCASE_PATTERN,
    VALID_STATUSES,
)
from ..functions.sqltext import Ref, stack_rows
from ..functions.text import is_title, parse_date

_KIND, _KEY, _N = "_kind", "_key", "_n"


def row_checks(df: DataFrame) -> list[tuple[str, int, str, Column]]:
    """(section, item, column, condition) of every check on one row whose columns are there."""
    types, out = dict(df.dtypes), []
    for i, (c, t) in enumerate(df.dtypes, start=1):
        v = F.col(c)
        gone = v.isNull() | F.isnan(v) if t in ("double", "float") else v.isNull()
        out.append(("COMPLETENESS", i, c, gone | F.lower(v).contains(DATE_SENTINEL) if t == "string" else gone))
    out.append(("DATA TYPES", 1, "date_of_birth", F.col("date_of_birth").rlike(DOB_DRIFT_PATTERN)))
    income = F.col("income")
    drift = (income.try_cast("double").isNull() if types.get("income") == "string" else income.isNull() | F.isnan(income))
    out.append(("DATA TYPES", 2, "income", drift))
    issue = "QUALITY ISSUES"
    out.append((issue, 1, "phone", F.col("phone").rlike(NONSTANDARD_PHONE_PATTERN)))
    out += [(issue, 2, c, F.col(c).contains(SLASH)) for c in DATE_COLUMNS]
    out += [(issue, 3, c, F.col(c).isNotNull() & ~is_title(c)) for c in NAME_COLUMNS]
    out.append((issue, 4, "email", F.col("email").rlike(UPPERCASE_PATTERN)))
    out.append((issue, 5, "account_status", ~F.lower("account_status").isin(list(VALID_STATUSES))))
    return [x for x in out if x[2] in types]


def customer_segments() -> dict[str, Column]:
    return {"account_status": F.col("account_status"), "created_year": F.year(parse_date("created_date"))}


def profile_by_segment(df: DataFrame, segments: dict[str, Column] | None = None, key: str = "customer_id",
                       sets: list[tuple] | None = None) -> DataFrame:
    """``(grouping_id, *segments, section, item_no, column_name, affected, total_rows, affected_percent)``.

    ``sets`` are the grouping sets over the segment names (default: all combinations); in
    ``grouping_id`` a bit is set for each segment that is totalled, the first one in the highest bit.
    Item 6 of the quality issues counts the rows whose key is held by more than one row of
    the segment (the null key counts).  One scan, two shuffles of narrow rows.
    """
    segments = segments or customer_segments()
    names = list(segments)
    if sets is None:
        sets = [tuple(n for j, n in enumerate(names) if not bits >> j & 1) for bits in range(1 << len(names))]
    checks = row_checks(df)
    flag = [f"_c{i}" for i in range(len(checks))]
    wide = df.select(*[c.alias(f"_s_{n}") for n, c in segments.items()], F.col(key).alias(_KEY),
                     *[F.coalesce(x[3], F.lit(False)).cast("int").alias(f) for f, x in zip(flag, checks)])
    seg = [f"_s_{n}" for n in names]
    counters = F.struct(F.lit(0).alias(_KIND), F.lit(None).cast(df.schema[key].dataType).alias(_KEY), *[F.col(f) for f in flag])
    keys = F.struct(F.lit(1).alias(_KIND), F.col(_KEY), *[F.lit(None).cast("int").alias(f) for f in flag])
    first = (wide.select(*seg, F.inline(F.array(counters, keys))).groupBy(*seg, _KIND, _KEY)
             .agg(F.count(F.lit(1)).alias(_N), *[F.sum(f).alias(f) for f in flag]))
    held = F.sum(_N).over(Window.partitionBy(_KIND, _KEY))  # one row per segment in which the key occurs
    some = first.withColumn("_held", held).where((F.col(_KIND) == 0) | (F.col("_held") > 1))
    col = {n: F.col(s) for n, s in zip(names, seg)}
    level = some.groupingSets([[*[col[n] for n in s], F.col(_KIND), F.col(_KEY)] for s in sets], *seg, _KIND, _KEY).agg(
        F.grouping_id().alias("_gid"), F.sum(_N).alias(_N), *[F.sum(f).alias(f) for f in flag])
    repeated = F.when((F.col(_KIND) == 1) & (F.col(_N) > 1), F.col(_N))
    sums = level.groupBy("_gid", *seg).agg(F.sum(F.when(F.col(_KIND) == 0, F.col(_N))).alias("_total"),
                                           *[F.sum(f).alias(f) for f in flag], F.coalesce(F.sum(repeated), F.lit(0)).alias("_repeated"))
    rows = tuple((s, i, c, Ref(f)) for (s, i, c, _), f in zip(checks, flag)) + (("QUALITY ISSUES", 6, key, Ref("_repeated")),)
    long = sums.select("_gid", *seg, "_total", stack_rows(("section", "item_no", "column_name", "affected"), rows))
    return long.select(
        F.shiftright("_gid", 2).cast("int").alias("grouping_id"), *[F.col(s).alias(n) for s, n in zip(seg, names)],
        "section", F.col("item_no").cast("int").alias("item_no"), "column_name", F.col("affected").cast("bigint").alias("affected"),
        F.col("_total").cast("bigint").alias("total_rows"),
        (F.col("affected").cast("double") / F.col("_total").cast("double") * F.lit(100.0)).alias("affected_percent"))
