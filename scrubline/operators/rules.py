"""Declarative column rules and suite evaluation.

A rule compiles to one boolean "unexpected" column.  Common semantics: a rule
looks only at non-null values of its column (except ``not_null``), bounds are
inclusive, and a rule succeeds when no value is unexpected.

Evaluation plans
----------------
* Suite metrics (V15/V16): all row-level rules are mergeable counters, so the
  whole suite is ONE aggregate (partial aggregation per task, a single row
  shuffled).  All ``unique`` rules together add one ``groupBy(rule, key).count()``
  (keys of several types stand in a column per type) whose
  map-side partial aggregation collapses hot keys (and the null key) before
  the shuffle, so a key that holds a third of the rows costs nothing extra.
* Samples (V17/V18) read the table once and join nothing: all rules are one stack
  with ``row_number() <= k`` per rule and key, then per rule, which Spark plans with a
  map-side WindowGroupLimit (each task ships at most k rows per rule, or per key of a
  ``unique`` rule).  Narrow columnar tables may be read again instead (see ``failures``).
* Row flags (X1) need the whole set of duplicated keys: that of all unique rules is
  written and counted by one job first, broadcast for a rule while it is small, and
  otherwise joined by shuffle with the rows that can match; null keys bypass it.
* Impact (V19) joins nothing, whatever the number of unique rules (see ``impact``).
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cache import cached_expr
from ..functions.sqltext import Expr, Ref, sql_literal, stack_rows
from ..session import new_run_dir
from ..functions.patterns import (
    CUSTOMER_ID_MIN, EXPECTATION_NAMES, INCOME_BOUNDS, NAME_LENGTH_BOUNDS, NAME_PATTERN, VALID_STATUSES,
)

# %Y-%m-%d as the strftime parser accepts it: four-digit year, one- or
# two-digit month and day, and a real calendar date.
_YMD_SHAPE = r"^[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9])$"


@dataclass(frozen=True)
class Rule:
    rule_id: int
    column: str
    kind: str
    params: tuple = field(default_factory=tuple)

    @property
    def expectation(self) -> str:
        return EXPECTATION_NAMES[self.kind]

    def param(self, name, default=None):
        return dict(self.params).get(name, default)

    def present(self, df: DataFrame) -> Column:
        """Non-missing values of the column (NaN counts as missing for doubles)."""
        return _present(self.column, dict(df.dtypes).get(self.column))

    def unexpected(self, df: DataFrame) -> Column:
        """Row-level 'unexpected' flag; never null.  Not defined for ``unique``."""
        return _unexpected(self, dict(df.dtypes).get(self.column))


@cached_expr
def _present(column: str, dtype: str | None) -> Column:
    c = F.col(column)
    if dtype in ("double", "float"):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


@cached_expr
def _unexpected(rule: Rule, dtype: str | None) -> Column:
    c = F.col(rule.column)
    k = rule.kind
    present = _present(rule.column, dtype)
    if k == "not_null":
        return ~present
    if k == "unique":
        raise ValueError("unique is evaluated by grouping, see flag_rows/evaluate")
    if k == "between":
        lo, hi = rule.param("min"), rule.param("max")
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (c >= F.lit(lo))
        if hi is not None:
            ok = ok & (c <= F.lit(hi))
        u = present & ~ok
    elif k == "length_between":
        u = present & ~F.length(c).between(rule.param("min"), rule.param("max"))
    elif k == "regex":
        u = present & ~c.rlike(rule.param("pattern"))
    elif k == "in_set":
        u = present & ~c.isin(list(rule.param("values")))
    elif k == "date_format":
        s = c.cast("string")
        u = present & ~(s.rlike(_YMD_SHAPE) & F.try_to_date(s, "yyyy-M-d").isNotNull())
    elif k == "date_order":
        later = F.try_to_date(c.cast("string"), "yyyy-M-d")
        earlier = F.try_to_date(F.col(rule.param("earlier")).cast("string"), "yyyy-M-d")
        u = later.isNotNull() & earlier.isNotNull() & (later <= earlier)
    else:  # pragma: no cover
        raise ValueError(f"unknown rule kind {k}")
    return F.coalesce(u, F.lit(False))


@cached_expr
def _flag(rule: Rule, dtype: str | None) -> Column:
    return _unexpected(rule, dtype).alias(f"_u{rule.rule_id}")


@cached_expr
def _suite_aggs(rules: tuple, dtypes: tuple) -> list:
    dt = dict(dtypes)
    return [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(_unexpected(r, dt.get(r.column))).alias(f"_u{r.rule_id}") for r in rules
    ]


_LONG_NAMES = ("rule_id", "column_name", "expectation", "element_count", "unexpected_count")


@cached_expr
def _suite_long(rules: tuple) -> Column:
    return stack_rows(_LONG_NAMES, tuple(
        (r.rule_id, r.column, r.expectation, Ref("_n"), Ref(f"_u{r.rule_id}")) for r in rules
    ))


@cached_expr
def _result_columns() -> list:
    return [
        F.col("rule_id").cast("int").alias("rule_id"),
        F.col("column_name"),
        F.col("expectation"),
        F.col("element_count").cast("bigint").alias("element_count"),
        F.col("unexpected_count").cast("bigint").alias("unexpected_count"),
        (F.col("unexpected_count") == 0).alias("success"),
    ]


def R(rule_id: int, column: str, kind: str, **params) -> Rule:
    return Rule(rule_id, column, kind, tuple(sorted(params.items())))


def customer_suite() -> list[Rule]:
    """The 14-rule customer suite, in evaluation order."""
    lo, hi = NAME_LENGTH_BOUNDS
    return [
        R(1, "customer_id", "not_null"),
        R(2, "customer_id", "unique"),
        R(3, "customer_id", "between", min=CUSTOMER_ID_MIN),
        R(4, "first_name", "not_null"),
        R(5, "first_name", "length_between", min=lo, max=hi),
        R(6, "first_name", "regex", pattern=NAME_PATTERN),
        R(7, "last_name", "not_null"),
        R(8, "last_name", "length_between", min=lo, max=hi),
        R(9, "income", "not_null"),
        R(10, "income", "between", min=INCOME_BOUNDS[0], max=INCOME_BOUNDS[1]),
        R(11, "account_status", "not_null"),
        R(12, "account_status", "in_set", values=VALID_STATUSES),
        R(13, "date_of_birth", "date_format"),
        R(14, "created_date", "date_format"),
    ]


def orders_suite() -> list[Rule]:
    """A generic suite on ``orders``: same rule kinds, other columns."""
    return [
        R(1, "o_orderkey", "not_null"),
        R(2, "o_orderkey", "unique"),
        R(3, "o_custkey", "not_null"),
        R(4, "o_totalprice", "between", min=0, max=500000),
        R(5, "o_orderstatus", "in_set", values=("O", "F")),
        R(6, "o_orderpriority", "regex", pattern=r"^[1-5]-[A-Z ]+$"),
        R(7, "o_orderpriority", "length_between", min=5, max=15),
    ]


def orders_key_suite() -> list[Rule]:
    """``orders_suite`` plus uniqueness of ``o_custkey``: most customers place
    several orders, so this rule has a large duplicate-key set."""
    return orders_suite() + [R(8, "o_custkey", "unique")]


def events_suite() -> list[Rule]:
    """A suite on ``events`` with three keys of different types, one of them unique."""
    return [
        R(1, "event_id", "unique"),
        R(2, "ts", "unique"),
        R(3, "value", "unique"),
        R(4, "value", "between", min=0, max=250),
        R(5, "event_type", "in_set", values=("click", "view", "purchase", "error", "signup")),
        R(6, "user_id", "not_null"),
    ]


def check_columns(df: DataFrame, rules: list[Rule]) -> None:
    """Fail up front, before any job, when a rule names an absent column."""
    missing = sorted({r.column for r in rules if r.column not in df.columns})
    if missing:
        raise ValueError(f"columns missing for rules: {missing}")


# --- V15/V16: suite metrics -----------------------------------------------------

_RESULT_COLS = ["rule_id", "column_name", "expectation", "element_count", "unexpected_count", "success"]


def _unique_result(df: DataFrame, r: Rule) -> DataFrame:
    c = F.col(r.column)
    per_key = df.groupBy(c.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(r.rule_id).alias("rule_id"),
        F.lit(r.column).alias("column_name"),
        F.lit(r.expectation).alias("expectation"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("element_count"),
        F.coalesce(F.sum(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0))
        .cast("bigint")
        .alias("unexpected_count"),
    )


_TYPED = "_k{}"


def _stacked_keys(df: DataFrame, uniques: list[Rule]) -> tuple[DataFrame, dict[str, str]]:
    """One row per row and ``unique`` rule: ``(rule_id, a key column per type)``; and the key column of each type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    slot: dict[str, str] = {}
    for r in uniques:
        slot.setdefault(types[r.column].simpleString(), _TYPED.format(len(slot)))
    cells = [F.struct(F.lit(r.rule_id).alias("rule_id"), *[
        (F.col(r.column) if types[r.column].simpleString() == t else F.lit(None).cast(t)).alias(c) for t, c in slot.items()]) for r in uniques]
    return df.select(F.inline(F.array(*cells))), slot


def _key_counts(df: DataFrame, uniques: list[Rule]) -> tuple[DataFrame, dict[str, str], Column]:
    """Rows per rule and key, one shuffle for all rules; the key column of each type; whether the key is there."""
    rows, slot = _stacked_keys(df, uniques)
    keys = list(slot.values())
    there = functools.reduce(operator.or_, [F.col(k).isNotNull() for k in keys])
    return rows.groupBy("rule_id", *keys).agg(F.count(F.lit(1)).alias("_n")), slot, there


def _unique_results(df: DataFrame, uniques: list[Rule]) -> DataFrame:
    """V15 rows of several ``unique`` rules."""
    counts, _, there = _key_counts(df, uniques)
    sums = counts.groupBy("rule_id").agg(
        F.sum("_n").alias("element_count"), F.coalesce(F.sum(F.when(there & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("unexpected_count"))
    # a rule has its row in the results of an empty table too
    zero = F.lit(0).cast("bigint")
    listed = [F.struct(F.lit(r.rule_id).alias("rule_id"), zero.alias("element_count"), zero.alias("unexpected_count")) for r in uniques]
    none = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
    both = sums.unionByName(none).groupBy("rule_id").agg(F.max("element_count").alias("element_count"), F.max("unexpected_count").alias("unexpected_count"))

    def named(what):
        return F.element_at(F.create_map(*[x for r in uniques for x in (F.lit(r.rule_id), F.lit(what(r)))]), F.col("rule_id"))
    return both.select("rule_id", named(lambda r: r.column).alias("column_name"), named(lambda r: r.expectation).alias("expectation"),
                       "element_count", "unexpected_count")


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule ``(rule_id, column_name, expectation, element_count,
    unexpected_count, success)``."""
    check_columns(df, rules)
    row_rules = tuple(r for r in rules if r.kind != "unique")
    parts = []
    if row_rules:
        dtypes = tuple(sorted(df.dtypes))
        parts.append(df.agg(*_suite_aggs(row_rules, dtypes)).select(_suite_long(row_rules)))
    uniques = [r for r in rules if r.kind == "unique"]
    if len(uniques) == 1:
        parts.append(_unique_result(df, uniques[0]))
    elif uniques:
        parts.append(_unique_results(df, uniques))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*_result_columns())


def summarize(results: DataFrame) -> DataFrame:
    """Suite statistics from V15 results (a tiny aggregate)."""
    return results.agg(*_summary_aggs())


@cached_expr
def _summary_aggs() -> list:
    ok = F.count_if(F.col("success"))
    n = F.count(F.lit(1))
    return [
        n.alias("evaluated_expectations"),
        ok.alias("successful_expectations"),
        (n - ok).alias("unsuccessful_expectations"),
        (ok.cast("double") * F.lit(100.0) / n.cast("double")).alias("success_percent"),
        F.coalesce(F.bool_and(F.col("success")), F.lit(True)).alias("success"),
    ]


# --- V17-V19: row-level flags ---------------------------------------------------

BROADCAST_KEYS = 200_000  # duplicated keys (one narrow row each) up to which they are broadcast


def _duplicated_keys(df: DataFrame, uniques: list[Rule]) -> dict[int, tuple[DataFrame, bool]]:
    """Per rule the non-null keys held by more than one row (column ``_dupkey<id>`` of a written table, one
    job for all rules), and whether they are few enough to broadcast."""
    counts, slot, there = _key_counts(df, uniques)
    keys = counts.where(there & (F.col("_n") > 1)).drop("_n")
    path = new_run_dir(df.sparkSession, "dup-keys")
    keys.write.partitionBy("rule_id").parquet(path)
    table = df.sparkSession.read.schema(keys.schema).parquet(path)
    found = {r.rule_id: r.n for r in table.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per rule
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return {r.rule_id: (table.where(F.col("rule_id") == r.rule_id).select(F.col(slot[types[r.column]]).alias(f"_dupkey{r.rule_id}")),
                        found.get(r.rule_id, 0) <= BROADCAST_KEYS) for r in uniques}


def flag_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add one boolean column ``_u{rule_id}`` per rule (True = unexpected).

    Runs one job for the ``unique`` rules (their duplicated keys are written and counted).
    """
    check_columns(df, rules)
    out = df
    uniques = [r for r in rules if r.kind == "unique"]
    duplicated = _duplicated_keys(df, uniques) if uniques else {}
    for r in uniques:
        flag, name = f"_u{r.rule_id}", f"_dupkey{r.rule_id}"
        keys, small = duplicated[r.rule_id]
        hit = F.col(name).isNotNull().alias(flag)
        if small:
            joined = out.join(F.broadcast(keys), out[r.column] == keys[name], "left")
            out = joined.select(*[out[c] for c in out.columns], hit)
        else:
            some, none = out.where(F.col(r.column).isNotNull()), out.where(F.col(r.column).isNull())
            joined = some.join(keys, some[r.column] == keys[name], "left")
            out = joined.select(*[some[c] for c in some.columns], hit).unionByName(none.withColumn(flag, F.lit(False)))
    dt = dict(df.dtypes)
    return out.select(
        *df.columns,
        *[F.col(f"_u{r.rule_id}") if r.kind == "unique" else _flag(r, dt.get(r.column)) for r in rules],
    )


def any_failed(rules: list[Rule]) -> Column:
    return F.greatest(*[F.col(f"_u{r.rule_id}") for r in rules]) if len(rules) > 1 else F.col(
        f"_u{rules[0].rule_id}"
    )


def _shown(column: str, dtype: str | None) -> Expr:
    """A value as text; doubles without an exponent up to 16 digits, as Python prints them."""
    c = sql_literal(Ref(column))
    if dtype not in ("double", "float"):
        return Expr(f"cast({c} as string)")
    plain = f"cast(try_cast({c} as decimal(38, 12)) as string)"
    return Expr(f"case when isnan({c}) then 'nan' when abs({c}) >= 1e7D and abs({c}) < 1e16D "
                f"then regexp_replace({plain}, '([.][0-9]+?)0+$', '$1') else cast({c} as string) end")


@cached_expr
def _failure_cells(rules: tuple, dtypes: tuple) -> tuple[Column, tuple]:
    """``stack`` of ``(rule_id, failed, value, *keys)``, and the names of the keys: a column per type of key, which
    only rows of ``unique`` rules fill."""
    types = dict(dtypes)
    slot: dict[str, str] = {}
    for r in rules:
        if r.kind == "unique":
            taken = r.column in ("rule_id", "failed", "value") or r.column.startswith("_")
            slot.setdefault(types[r.column], f"_key_{r.column}" if taken else r.column)
    rows = []
    for r in rules:
        own = types.get(r.column) if r.kind == "unique" else None
        c = sql_literal(Ref(r.column))
        failed, value = ((Expr(f"{c} is not null"), Expr("cast(null as string)")) if own  # the key says it
                         else (Ref(f"_u{r.rule_id}"), _shown(r.column, types.get(r.column))))
        keys = (Ref(r.column) if t == own else Expr(f"cast(null as {t})") for t in slot)
        rows.append((r.rule_id, failed, value, *keys))
    return stack_rows(("rule_id", "failed", "value", *slot.values()), tuple(rows)), tuple(slot.values())


def failures(df: DataFrame, rules: list[Rule], order_col: str, k: int = 3, show: tuple | None = None,
             rescan: bool = False) -> DataFrame:
    """Per failed rule, its first ``k`` unexpected values in ``order_col`` order.

    Output ``(rule_id, column_name, expectation, sample_no, *show, value)``; ``show``
    (default: the order column) names columns that identify the row.  Rows with
    equal order values are taken in order of the value.

    One scan, whatever the rules: rows that fail, and rows with a key of a ``unique`` rule,
    are cut to the first ``max(k, 2)`` of each (rule, key), within a task, then after one
    shuffle by key, so a hot key is that many rows per task.  A key of which two rows are left
    is a repeated one, and the first ``k`` rows of a rule are among those left.

    This sorts the rows of each task by key.  Where reading a row costs less than sorting it (a
    narrow columnar table with few keys), ``rescan`` counts the keys of each ``unique`` rule by
    hash instead, cuts them to the ``k`` repeated ones that start first, to which the first
    ``k`` rows belong, and reads the table again for those.  Both give the same rows.
    """
    check_columns(df, rules)
    show = show or (order_col,)
    named = [c for c in show if c != order_col]
    shown = [F.col(order_col).alias("_ord"), *[F.col(c).alias(f"_s_{c}") for c in named]]
    dtypes = tuple(sorted(df.dtypes))
    dt = dict(dtypes)
    plain = [r for r in rules if r.kind != "unique"]
    uniques = [r for r in rules if r.kind == "unique"]
    stacked = plain if rescan else rules
    parts = []
    if stacked:
        flagged = df.select("*", *[_flag(r, dt.get(r.column)) for r in plain])
        cells, keys = _failure_cells(tuple(stacked), dtypes)
        failed = flagged.select(*shown, cells).where(F.col("failed")).drop("failed")
        parts.append(_first_of_keys(failed, keys, [r.rule_id for r in uniques], k) if keys else failed)
    if rescan:
        parts += [_rows_of_first_keys(df, r, order_col, shown, k) for r in uniques]
    long = functools.reduce(DataFrame.unionByName, parts)
    w = Window.partitionBy("rule_id").orderBy("_ord", "value")
    top = long.withColumn("sample_no", F.row_number().over(w)).where(F.col("sample_no") <= k)
    return top.select(*_failure_columns(tuple(rules), tuple(show), order_col))


def _first_of_keys(failed: DataFrame, keys: tuple, uniques: list[int], k: int) -> DataFrame:
    """The first rows of each (rule, key) without the keys of ``unique`` rules that one row holds."""
    held = Window.partitionBy(*keys, "rule_id")
    first = failed.withColumn("_nth", F.row_number().over(held.orderBy("_ord", "value"))).where(F.col("_nth") <= max(k, 2))
    repeated = first.withColumn("_rows", F.max("_nth").over(held))  # of max(k, 2) rows at most
    return (repeated.where((F.col("_rows") > 1) | ~F.col("rule_id").isin(uniques))
            .withColumn("value", F.coalesce("value", *[F.col(c).cast("string") for c in keys])).drop("_nth", "_rows", *keys))


def _rows_of_first_keys(df: DataFrame, rule: Rule, order_col: str, shown: list, k: int) -> DataFrame:
    """The rows of the ``k`` repeated keys that start first."""
    c = F.col(rule.column)
    first = (df.where(c.isNotNull()).groupBy(c.alias("_key"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_first"))
             .where(F.col("_n") > 1).orderBy("_first", "_key").limit(k).select("_key"))
    held = df.select(*shown, F.lit(rule.rule_id).alias("rule_id"), c.alias("_c"), c.cast("string").alias("value"))
    return held.join(F.broadcast(first), F.col("_c") == F.col("_key")).drop("_c", "_key")  # k keys at most


@cached_expr
def _failure_columns(rules: tuple, show: tuple, order_col: str) -> list:
    def lookup(values):
        return F.element_at(F.create_map(*[x for r, v in zip(rules, values) for x in (F.lit(r.rule_id), F.lit(v))]),
                            F.col("rule_id"))
    return [
        F.col("rule_id").cast("int").alias("rule_id"),
        lookup([r.column for r in rules]).alias("column_name"),
        lookup([r.expectation for r in rules]).alias("expectation"),
        F.col("sample_no").cast("int").alias("sample_no"),
        *[F.col("_ord" if c == order_col else f"_s_{c}").alias(c) for c in show],
        F.col("value"),
    ]


def impact(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct rows failing at least one rule, and the total.

    With at most one ``unique`` rule this is one pre-aggregated ``groupBy`` on
    the key and no join: per key, the rows and the rows failing any other
    rule; every row of a duplicated (non-null) key is impacted, otherwise only
    its failing rows.  A hot key is one partial row per task.

    With more of them, the rows that pass are counted instead.  Rows that pass the other
    rules are candidates; for one unique rule after the other, all rows and the
    candidates are grouped by its key, and a key that only one row of the table holds
    hands on its candidate, which the group's maxima carry (there is only one).  Null
    keys pass: such a candidate is a group of its own.  One shuffle of narrow rows per rule.
    """
    check_columns(df, rules)
    uniques = [r for r in rules if r.kind == "unique"]
    others = [r for r in rules if r.kind != "unique"]
    dt = dict(df.dtypes)
    failing = (F.greatest(*[_unexpected(r, dt.get(r.column)) for r in others]) if len(others) > 1
               else _unexpected(others[0], dt.get(others[0].column)) if others else F.lit(False))
    if not uniques:
        return df.agg(F.count_if(failing).alias("impacted_rows"), F.count(F.lit(1)).alias("total_rows"))
    if len(uniques) > 1:
        columns = list(dict.fromkeys(r.column for r in uniques))
        passing = df.where(~failing).select(*columns)
        for i, c in enumerate(columns):
            rest, types = columns[i + 1:], {x: df.schema[x].dataType for x in columns[i + 1:]}
            every = df.where(F.col(c).isNotNull()).select(c, F.lit(None).cast("bigint").alias("_own"), F.lit(1).alias("_all"), F.lit(0).alias("_may"),
                                                          *[F.lit(None).cast(types[x]).alias(x) for x in rest])
            may = passing.select(c, F.when(F.col(c).isNull(), F.monotonically_increasing_id()).alias("_own"), F.lit(0).alias("_all"),
                                 F.lit(1).alias("_may"), *rest)
            per_key = every.unionByName(may).groupBy(c, "_own").agg(F.sum("_all").alias("_all"), F.sum("_may").alias("_may"),
                                                                    *[F.max(x).alias(x) for x in rest])
            passing = per_key.where((F.col("_may") == 1) & (F.col(c).isNull() | (F.col("_all") == 1))).select(*rest)
        counts = (passing.agg(F.count(F.lit(1)).alias("_pass")).select(F.lit(0).cast("bigint").alias("_n"), "_pass")
                  .unionByName(df.agg(F.count(F.lit(1)).alias("_n")).select("_n", F.lit(0).cast("bigint").alias("_pass"))))
        return counts.agg((F.sum("_n") - F.sum("_pass")).alias("impacted_rows"), F.sum("_n").alias("total_rows"))
    key = F.col(uniques[0].column)
    per_key = df.groupBy(key.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(failing).alias("_bad")
    )
    dup = F.col("_k").isNotNull() & (F.col("_n") > 1)
    return per_key.agg(
        F.coalesce(F.sum(F.when(dup, F.col("_n")).otherwise(F.col("_bad"))), F.lit(0)).cast("bigint")
        .alias("impacted_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def tag_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with ``_failed``: the ids of the rules that each row fails."""
    flags = flag_rows(df, rules)
    failed = F.array_compact(
        F.array(*[F.when(F.col(f"_u{r.rule_id}"), F.lit(r.rule_id)) for r in rules])
    )
    return flags.select(*df.columns, failed.alias("_failed"))


def quarantine_split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``failed_rules`` text).

    Every failing rule is named in the one ``tagged`` projection; a caller that wants
    both sides from one pass writes ``tag_rows`` once and filters the table.
    """
    tagged = tag_rows(df, rules)
    rejected = tagged.where(F.size("_failed") > 0).select(
        *df.columns,
        F.array_join(F.col("_failed").cast("array<string>"), ",").alias("failed_rules"),
        F.size("_failed").alias("n_failed"),
    )
    accepted = tagged.where(F.size("_failed") == 0).select(*df.columns)
    return accepted, rejected


def assert_quality(df: DataFrame, rules: list[Rule], critical: dict[int, float]) -> DataFrame:
    """Raise when a critical rule fails for at least the given share of rows.

    ``critical`` maps rule_id -> threshold in [0, 1].  Returns the V15 results
    (one small aggregate job) so callers can log them.
    """
    res = evaluate(df, rules).collect()  # one row per rule: bounded by the suite size
    check_gate(res, critical)
    return df.sparkSession.createDataFrame(res)


def gate(results: DataFrame, critical: dict[int, float]) -> DataFrame:
    """X4 as a table: per critical rule its share of failing rows, the threshold and whether it halts."""
    limits = F.create_map(*[x for k, v in critical.items() for x in (F.lit(k), F.lit(float(v)))])
    share = F.col("unexpected_count").cast("double") / F.nullif(F.col("element_count"), F.lit(0)).cast("double")
    rows = results.withColumn("threshold", F.element_at(limits, F.col("rule_id"))).where(F.col("threshold").isNotNull())
    return rows.select("rule_id", "column_name", "expectation", share.alias("failed_share"), "threshold",
                       F.coalesce(share >= F.col("threshold"), F.lit(False)).alias("halts"))


def check_gate(results, critical: dict[int, float]) -> None:
    """X4 on collected V15 rows (one per rule)."""
    for row in results:
        thr = critical.get(row.rule_id)
        if thr is None or row.element_count == 0:
            continue
        share = row.unexpected_count / row.element_count
        if share >= thr:
            raise QualityGateError(
                f"rule {row.rule_id} ({row.column_name}, {row.expectation}) failed for "
                f"{share:.2%} of rows (threshold {thr:.2%})"
            )


class QualityGateError(RuntimeError):
    pass
