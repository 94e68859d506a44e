"""Equivalent SQL (DuckDB dialect) for every named query in ``catalog``.

These strings are the correctness oracle: they run on the same parquet
tables, registered as views, and must give the same rows as the Spark
queries.  They are written independently of the Spark code (their own text of the
dirty table and of each rule, RE2 regexes, DuckDB date parsing) and share only the
fixed values of ``functions/patterns.py`` and the names in the rule suites.
"""

from __future__ import annotations

from ..functions.patterns import (
    DATE_SENTINEL, DOB_DRIFT_PATTERN, EMAIL_PATTERN, FILL_VALUES, FORMATTED_PHONE_PATTERN, ISO_DATE_PATTERN,
    NONSTANDARD_PHONE_PATTERN, PHONE_PATTERN, PY_SPACE, RISK_LEVELS, UPPERCASE_PATTERN, VALID_STATUSES,
)
from ..operators.rules import Rule, customer_suite, events_suite, orders_key_suite, orders_suite

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_DUCK_DATE_FORMATS = (
    "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%Y%m%d", "%Y.%m.%d",
    "%b %d %Y", "%B %d %Y", "%d %b %Y", "%d %B %Y", "%d-%b-%Y", "%m.%d.%Y", "%d.%m.%Y", "%b-%d-%Y", "%Y-%b-%d",
)

# The dirty table by position in lists; ``ord`` is the place of the row in the file.
DIRTY_SQL = """
select k as ord,
  case when k % 97 = 13 then null else case when k % 89 = 5 then 0 - k else case when k % 53 = 7 then 50
    else k + 2 - 2 * (k % 2) end end end as customer_id,
  ['John', 'jane', 'MARY', null, 'o''brien', 'A', '  ann  marie ', repeat('x', 51), c_name, 'Élodie', 'mary-jane',
   'Robert', 'Robert', 'Robert', 'Robert', 'Robert'][k % 16 + 1] as first_name,
  ['Doe', 'smith', null, 'mary-jane', 'Q', repeat('long', 13), ' lee ', 'd''arc', 'Moore', 'Moore', 'Moore', 'Moore',
   'Moore'][k % 13 + 1] as last_name,
  case when k % 50 = 49 then null when k % 10 = 5 then 'USER' || k || '@EXAMPLE.COM' when k % 50 = 48 then 'not-an-email'
    when k % 60 = 17 then ' pad.' || k || '@example.com ' else 'user.' || k || '@example.com' end as email,
  ['555-123-' || l, '(555) 123-' || l, '555.123.' || l, '555123' || l, '12345', null, '+1 555 123 4567'][k % 7 + 1] as phone,
  ['invalid_date', y || '/05/10', '01/15/' || y, y || '-03-15', y || '-1-5', '25/12/' || y, '01-15-' || y, '25-12-' || y,
   y || '0704', y || '.06.07', 'Jan 15, ' || y, 'march 3 ' || y, '15 JAN ' || y, '4 July, ' || y, '05-Feb-' || y,
   y || '-03-15 10:30', y || '-03-15T10:30:45', y || '-03-15 10:30:45.123', y || '/05/10 10:00:00', '1/15/' || y || ' 9:05',
   '1/5/' || y[3:4], '25-12-' || y[3:4], y || '-02-30', 'soon', null, '15.01.' || y, '15-Jan-' || y[3:4],
   'Jan-15-' || y, y || '-Jan-15', '15 Jan ' || y[3:4], '22nd January ' || y, 'Monday, January 15, ' || y, 'Sept 5 ' || y, ' ' || y || '-10-01 '][k % 34 + 1] as date_of_birth,
  [k || ' Main St', null, '12 "Old" Rd, NY ' || k, '  ' || k || ' Blank St ', 'Flat 1' || chr(10) || k || ' Main St', 'NY',
   k || ' Main St', k || ' Main St'][k % 8 + 1] as address,
  case when k % 9 = 2 then null when k % 31 = 4 then 'nan'::double when k % 37 = 6 then 10000001.5::double
    when k % 41 = 9 then -1.0::double else c_acctbal end as income,
  ['active', 'inactive', 'suspended', null, 'ACTIVE', if(k % 3 = 0, 'it''s', 'active'), 'bad' || ((k // 8) % 12),
   'active'][k % 8 + 1] as account_status,
  case when k % 20 = 19 then 'invalid_date' when k % 20 = 11 then '1949-01-01' when k % 20 = 7 then '01/31/2024'
    when k % 20 = 3 then '2024-01-10 08:15' when k % 20 = 5 then null else '2024-01-10' end as created_date
from (select c_custkey as k, c_name, c_acctbal, cast(1950 + c_custkey % 50 as varchar) as y,
        right('0000' || (c_custkey % 10000), 4) as l from customer)
"""
# a calendar date as year-month-day text, one- or two-digit month and day
_YMD = r"^\d{4}-\d{1,2}-\d{1,2}$"
_TIME = r"[ T]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + PY_SPACE + '+|' + PY_SPACE + '+$')}, '', 'g')"


def title(x: str) -> str:
    runs = f"regexp_extract_all({x}, {q('[' + _CASED + ']+|[^' + _CASED + ']+')})"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def is_title(x: str) -> str:
    return f"({title(x)} = {x} and regexp_matches({x}, {q('[' + _CASED + ']')}))"


def iso(x: str) -> str:
    fmts = "[" + ", ".join(q(f) for f in _DUCK_DATE_FORMATS) + "]"
    day = f"regexp_replace(trim({x}), {q(_TIME)}, '')"
    bare = f"regexp_replace(regexp_replace(regexp_replace({day}, '^[A-Za-z]+day, ', ''), '^Sept ', 'Sep '), '^([0-9]+)(st|nd|rd|th) ', '\\1 ')"
    named = f"if(regexp_matches({day}, '[A-Za-z]'), replace({bare}, ',', ''), {day})"
    century = f"if(right({day}, 2) >= '69', '19', '20')"
    full = (f"if(regexp_matches({day}, {q(r'^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2}$|^[0-9]{1,2}[- ][A-Za-z]+[- ][0-9]{2}$')}), "
            f"left({day}, length({day}) - 2) || {century} || right({day}, 2), {named})")
    return f"strftime(cast(try_strptime({full}, {fmts}) as date), '%Y-%m-%d')"


def date_clean(x: str) -> str:
    return iso(f"nullif({x}, {q(DATE_SENTINEL)})")


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def phone_clean(x: str) -> str:
    d = digits(x)
    return (f"case when length({d}) = 10 then substr({d}, 1, 3) || '-' || substr({d}, 4, 3) || '-' || "
            f"substr({d}, 7, 4) else {x} end")


def name_clean(x: str) -> str:
    return title(strip(x))


STATUS_SET = "(" + ", ".join(q(v) for v in VALID_STATUSES) + ")"

DIRTY = f"dirty as ({DIRTY_SQL})"
CLEANED = f"""cleaned as (
  select ord, customer_id,
    coalesce({name_clean('first_name')}, '[UNKNOWN]') as first_name,
    coalesce({name_clean('last_name')}, '[UNKNOWN]') as last_name,
    lower(email) as email,
    coalesce({phone_clean('phone')}, 'UNKNOWN') as phone,
    coalesce({date_clean('date_of_birth')}, '[UNKNOWN]') as date_of_birth,
    coalesce(address, '[UNKNOWN]') as address,
    case when income is null or isnan(income) then 0.0 else income end as income,
    coalesce(account_status, 'unknown') as account_status,
    coalesce({date_clean('created_date')}, '[UNKNOWN]') as created_date
  from dirty)"""
MASKED = f"""masked as (
  select ord, customer_id,
    case when first_name is null or first_name = '[UNKNOWN]' then first_name
      else substr(first_name, 1, 1) || '***' end as first_name,
    case when last_name is null or last_name = '[UNKNOWN]' then last_name
      else substr(last_name, 1, 1) || '***' end as last_name,
    case when contains(email, '@') then
      substr(string_split(email, '@')[1], 1, 1) || '***@' || string_split(email, '@')[-1] else email end as email,
    case when regexp_matches(phone, {q(FORMATTED_PHONE_PATTERN)}) then '***-***-' || right(phone, 4)
      else '***-***-****' end as phone,
    case when length(date_of_birth) >= 4 then substr(date_of_birth, 1, 4) || '-**-**'
      else date_of_birth end as date_of_birth,
    '[MASKED ADDRESS]' as address, income, account_status, created_date
  from cleaned)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# --- rules ----------------------------------------------------------------------------

def _present(r: Rule, dtypes: dict) -> str:
    c = r.column
    return f"({c} is not null and not isnan({c}))" if dtypes.get(c) == "double" else f"({c} is not null)"


def rule_sql(r: Rule, table: str, dtypes: dict) -> str:
    """The 'unexpected' predicate of one rule, never null."""
    c = r.column
    p = dict(r.params)
    pres = _present(r, dtypes)
    if r.kind == "not_null":
        return f"(not {pres})"
    if r.kind == "unique":
        return (f"coalesce({c} in (select {c} from {table} where {c} is not null group by {c} "
                f"having count(*) > 1), false)")
    if r.kind == "between":
        conds = []
        if p.get("min") is not None:
            conds.append(f"{c} >= {p['min']}")
        if p.get("max") is not None:
            conds.append(f"{c} <= {p['max']}")
        u = f"{pres} and not ({' and '.join(conds)})"
    elif r.kind == "length_between":
        u = f"{pres} and not (length({c}) between {p['min']} and {p['max']})"
    elif r.kind == "regex":
        u = f"{pres} and not regexp_matches({c}, {q(p['pattern'])})"
    elif r.kind == "in_set":
        u = f"{pres} and {c} not in ({', '.join(q(v) for v in p['values'])})"
    elif r.kind == "date_format":
        s = f"cast({c} as varchar)"
        u = (f"{pres} and not (regexp_matches({s}, {q(_YMD)}) and "
             f"try_strptime({s}, '%Y-%m-%d') is not null)")
    else:  # pragma: no cover
        raise ValueError(r.kind)
    return f"coalesce({u}, false)"


CUSTOMER_TYPES = {"customer_id": "bigint", "income": "double"}
EVENTS_TYPES = {"event_id": "bigint", "ts": "timestamp", "value": "double"}
ORDERS_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}


def flags_cte(name: str, table: str, rules: list[Rule], dtypes: dict, key: str) -> str:
    cols = ", ".join(f"{rule_sql(r, table, dtypes)} as u{r.rule_id}" for r in rules)
    return f"{name} as (select *, {cols} from {table})"


def evaluate_sql(flags: str, table: str, rules: list[Rule]) -> str:
    legs = []
    for r in rules:
        if r.kind == "unique":
            legs.append(
                f"select {r.rule_id} as rule_id, {q(r.column)} as column_name, {q(r.expectation)} as expectation, "
                f"cast(coalesce(sum(n), 0) as bigint) as element_count, "
                f"cast(coalesce(sum(case when k is not null and n > 1 then n end), 0) as bigint) as unexpected_count "
                f"from (select {r.column} as k, count(*) as n from {table} group by 1)"
            )
        else:
            legs.append(
                f"select {r.rule_id} as rule_id, {q(r.column)} as column_name, {q(r.expectation)} as expectation, "
                f"count(*) as element_count, count(*) filter (where u{r.rule_id}) as unexpected_count from {flags}"
            )
    return ("select rule_id, column_name, expectation, element_count, unexpected_count, "
            "unexpected_count = 0 as success from (" + "\nunion all\n".join(legs) + ")")


def summary_sql(results: str) -> str:
    return (f"select count(*) as evaluated_expectations, count(*) filter (where success) as successful_expectations, "
            f"count(*) - count(*) filter (where success) as unsuccessful_expectations, "
            f"cast(count(*) filter (where success) as double) * 100.0 / cast(count(*) as double) as success_percent, "
            f"coalesce(bool_and(success), true) as success from ({results})")


def failures_long_sql(flags: str, rules: list[Rule], key: str) -> str:
    return "\nunion all\n".join(
        f"select {r.rule_id} as rule_id, {q(r.column)} as column_name, {q(r.expectation)} as expectation, "
        f"{key}, cast({r.column} as varchar) as value from {flags} where u{r.rule_id}"
        for r in rules
    )


SUITE = customer_suite()
RAW_FLAGS = flags_cte("fr", "dirty", SUITE, CUSTOMER_TYPES, "customer_id")
CLEAN_FLAGS = flags_cte("fc", "cleaned", SUITE, CUSTOMER_TYPES, "customer_id")
ANY_FAILED = " or ".join(f"u{r.rule_id}" for r in SUITE)

# --- profile pieces ---------------------------------------------------------------------

CUSTOMER_COLUMNS = (
    ("customer_id", "bigint"), ("first_name", "varchar"), ("last_name", "varchar"), ("email", "varchar"),
    ("phone", "varchar"), ("date_of_birth", "varchar"), ("address", "varchar"), ("income", "double"),
    ("account_status", "varchar"), ("created_date", "varchar"),
)
ORDERS_COLUMNS = (
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "varchar"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp"), ("o_orderpriority", "varchar"),
)


def completeness_sql(table: str, columns) -> str:
    legs = []
    for i, (c, t) in enumerate(columns, start=1):
        null = f"{c} is null or isnan({c})" if t == "double" else f"{c} is null"
        sent = (f"count(*) filter (where contains(lower({c}), {q(DATE_SENTINEL)}))" if t == "varchar"
                else "cast(0 as bigint)")
        legs.append(f"select {i} as ordinal, {q(c)} as column_name, count(*) filter (where {null}) as null_count, "
                    f"{sent} as sentinel_count, count(*) as total_rows from {table}")
    return ("select ordinal, column_name, null_count, sentinel_count, null_count + sentinel_count as missing_count, "
            "cast(total_rows - null_count - sentinel_count as double) / cast(nullif(total_rows, 0) as double) * 100.0 "
            "as complete_percent, total_rows from (" + "\nunion all\n".join(legs) + ")")


TYPES_SQL = """select * from (values (1, 'customer_id', 'INT', null), (2, 'first_name', 'STRING', null),
  (3, 'last_name', 'STRING', null), (4, 'email', 'STRING', null), (5, 'phone', 'STRING', null),
  (6, 'address', 'STRING', null), (7, 'account_status', 'STRING', null)) t(ordinal, column_name, reported_type, note)
union all
select 8, 'date_of_birth', 'STRING', 'should be DATE'
  where (select coalesce(bool_or(regexp_matches(date_of_birth, {dob})), false) from dirty)
union all
select 9, 'income', 'NUMERIC', 'detected as Mixed/Object'
  where (select coalesce(bool_or(income is null or isnan(income)), false) from dirty)""".format(
    dob=q(DOB_DRIFT_PATTERN))

SLASH_SQL = """select column_ordinal, column_name, value, cast(min(ord) as bigint) as first_seen,
  count(*) as occurrences from (
  select 1 as column_ordinal, 'date_of_birth' as column_name, date_of_birth as value, ord from dirty
    where contains(date_of_birth, '/')
  union all
  select 2, 'created_date', created_date, ord from dirty where contains(created_date, '/'))
group by column_ordinal, column_name, value"""

INVALID_STATUS_SQL = f"""select account_status as value, cast(min(ord) as bigint) as first_seen,
  count(*) as occurrences from dirty
where account_status is not null and lower(account_status) not in {STATUS_SET}
group by account_status"""


def py_repr(x: str) -> str:
    """Python's repr of a string."""
    esc = f"replace(replace({x}, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')"
    return (f"if(contains({x}, chr(39)) and not contains({x}, chr(34)), chr(34) || {esc} || chr(34), "
            f"chr(39) || replace({esc}, chr(39), chr(92) || chr(39)) || chr(39))")


def _list_repr(value: str, order: str) -> str:
    return f"'[' || string_agg({py_repr(value)}, ', ' order by {order}) || ']'"


ISSUES_SQL = f"""iss as (
  with c as (select
      count(*) filter (where regexp_matches(phone, {q(NONSTANDARD_PHONE_PATTERN)})) as c1,
      count(*) filter (where contains(date_of_birth, '/')) + count(*) filter (where contains(created_date, '/')) as c2,
      count(*) filter (where first_name is not null and not {is_title('first_name')}) as c3f,
      count(*) filter (where last_name is not null and not {is_title('last_name')}) as c3l,
      arg_min(first_name, ord) filter (where first_name is not null and not {is_title('first_name')}) as e3f,
      arg_min(last_name, ord) filter (where last_name is not null and not {is_title('last_name')}) as e3l,
      count(*) filter (where regexp_matches(email, {q(UPPERCASE_PATTERN)})) as c4
    from dirty),
  ph as (select {_list_repr('phone', 'ord')} as ex from (
      select phone, ord from dirty where regexp_matches(phone, {q(NONSTANDARD_PHONE_PATTERN)})
      order by ord limit 2)),
  sd as (select {_list_repr('value', 'column_ordinal, first_seen')} as ex from (
      select * from ({SLASH_SQL}) order by column_ordinal, first_seen limit 3)),
  cat as (select {py_repr('value')} as ex, occurrences from ({INVALID_STATUS_SQL})),
  dup as (select cast(coalesce(sum(n), 0) as bigint) as affected from (
      select customer_id, count(*) as n from dirty group by customer_id having count(*) > 1)),
  parts as (
    select 1 as check_no, c1 as affected, (select ex from ph) as examples from c
    union all select 2, c2, (select ex from sd) from c
    union all select 3, c3f + c3l, concat_ws(', ',
        case when c3f > 0 then 'first_name (''' || e3f || ''')' end,
        case when c3l > 0 then 'last_name (''' || e3l || ''')' end) from c
    union all select 4, c4, null from c
    union all select 5, occurrences, ex from cat
    union all select 6, affected, null from dup)
  select cast(dense_rank() over (order by check_no) as integer) as issue_no, check_no,
    case check_no when 1 then 'Non-standard Phone Formats'
      when 2 then 'Inconsistent Date Formats (Slashes detected)' when 3 then 'Inconsistent Name Casing'
      when 4 then 'Non-standard Email Casing (Uppercase detected)' when 5 then 'Invalid Category Values'
      else 'Duplicate Customer IDs detected.' end as issue,
    case check_no when 1 then 'phone' when 2 then 'date_of_birth,created_date' when 3 then 'first_name,last_name'
      when 4 then 'email' when 5 then 'account_status' else 'customer_id' end as column_name,
    cast(affected as bigint) as affected, examples
  from parts where affected > 0)"""


def pct_text(x: str) -> str:
    return f"cast(cast(round_even({x}, 0) as bigint) as varchar)"


REPORT_SQL = with_(DIRTY, ISSUES_SQL) + f"""
select 1 as section_no, 'COMPLETENESS' as section, ordinal as item_no, column_name,
  column_name || ': ' || {pct_text('complete_percent')} || '%' ||
  case when missing_count > 0 then ' (' || cast(missing_count as varchar) || ' missing/invalid)' else '' end as line
from ({completeness_sql('dirty', CUSTOMER_COLUMNS)})
union all
select 2, 'DATA TYPES', ordinal, column_name,
  column_name || ': ' || reported_type || case when note is not null then '  (' || note || ')' else '' end
from ({TYPES_SQL})
union all
select 3, 'QUALITY ISSUES', issue_no, column_name,
  cast(issue_no as varchar) || '. ' || issue ||
  case when check_no = 1 then ', Examples: ' || examples
       when check_no in (2, 3, 5) then ': ' || examples else '' end
from iss"""

# --- PII ------------------------------------------------------------------------------

def pii_scan_sql(table: str) -> str:
    legs = [
        ("email", "email", f"regexp_matches(email, {q(EMAIL_PATTERN)})"),
        ("phone", "phone", f"regexp_matches(phone, {q(PHONE_PATTERN)})"),
        ("address", "address", "address is not null and length(address) > 5"),
        ("dob", "date_of_birth", f"date_of_birth is not null and lower(date_of_birth) <> {q(DATE_SENTINEL)}"),
    ]
    body = "\nunion all\n".join(
        f"select {q(t)} as pii_type, {q(c)} as column_name, count(*) filter (where {cond}) as found_rows, "
        f"count(*) as total_rows from {table}"
        for t, c, cond in legs
    )
    return (f"select pii_type, column_name, found_rows, total_rows, "
            f"cast(found_rows as double) / cast(nullif(total_rows, 0) as double) * 100.0 as found_percent "
            f"from ({body})")


def text_scan_wide_sql(table: str, col: str, group_cols=()) -> str:
    g = ", ".join(group_cols)
    sel = (g + ", ") if g else ""
    inner = (f"select {sel}len(regexp_extract_all({col}, {q(EMAIL_PATTERN)})) as ne, "
             f"len(regexp_extract_all({col}, {q(PHONE_PATTERN)})) as np from {table}")
    aggs = ("count(*) as total_docs, count(*) filter (where ne > 0) as email_docs, "
            "cast(coalesce(sum(ne), 0) as bigint) as email_matches, count(*) filter (where np > 0) as phone_docs, "
            "cast(coalesce(sum(np), 0) as bigint) as phone_matches")
    return f"select {sel}{aggs} from ({inner})" + (f" group by {g}" if g else "")


def text_scan_sql(table: str, col: str) -> str:
    w = text_scan_wide_sql(table, col)
    return (f"with w as ({w}) select 'email' as pii_type, email_docs as docs_with_match, email_matches as match_count, "
            f"total_docs from w union all select 'phone', phone_docs, phone_matches, total_docs from w")


RISK_VALUES = ", ".join(f"({q(c)}, {q(r)})" for c, r in RISK_LEVELS)

# --- cleaning counters ------------------------------------------------------------------

CLEAN_STATS_SQL = f"""select
  count(*) filter (where length({digits('phone')}) = 10) as phone_fixes,
  count(*) filter (where phone is not null and phone <> {phone_clean('phone')}) as phone_changed,
  count(*) filter (where nullif(date_of_birth, {q(DATE_SENTINEL)}) is not null
                   and not regexp_matches(date_of_birth, {q(ISO_DATE_PATTERN)}))
  + count(*) filter (where nullif(created_date, {q(DATE_SENTINEL)}) is not null
                   and not regexp_matches(created_date, {q(ISO_DATE_PATTERN)})) as date_fixes,
  count(*) filter (where first_name is not null and first_name <> {name_clean('first_name')})
  + count(*) filter (where last_name is not null and last_name <> {name_clean('last_name')}) as name_fixes,
  count(*) filter (where email is not null and email <> lower(email)) as email_fixes
from dirty"""

_FILL_EXPR = {
    "first_name": name_clean("first_name"),
    "last_name": name_clean("last_name"),
    "address": "address",
    "date_of_birth": date_clean("date_of_birth"),
    "phone": phone_clean("phone"),
    "created_date": date_clean("created_date"),
    "account_status": "account_status",
    "income": "income",
}


def _fill_missing(c: str) -> str:
    e = _FILL_EXPR[c]
    return f"({e} is null or isnan({e}))" if c == "income" else f"({e} is null)"


MISSING_COUNTS_SQL = "\nunion all\n".join(
    f"select {i} as ordinal, {q(c)} as column_name, {q(str(v))} as fill_value, "
    f"count(*) filter (where {_fill_missing(c)}) as missing_count, "
    f"count(*) filter (where {_fill_missing(c)}) * {2 if c == 'income' else 1} as logged_count from dirty"
    for i, (c, v) in enumerate(FILL_VALUES.items(), start=1)
)

DATE_REJECTS_SQL = "\nunion all\n".join(
    f"select customer_id, {q(c)} as column_name, {c} as value from dirty "
    f"where {c} is not null and {c} <> {q(DATE_SENTINEL)} and {date_clean(c)} is null"
    for c in ("date_of_birth", "created_date"))

# --- assembled oracle dictionary ----------------------------------------------------------

CUSTOMER_COLS = ", ".join(c for c, _ in CUSTOMER_COLUMNS)


def _any(rules: list[Rule]) -> str:
    return " or ".join(f"u{r.rule_id}" for r in rules)


def _stage_union(raw_sql: str, clean_sql: str) -> str:
    return f"select 'raw' as stage, * from ({raw_sql})\nunion all\nselect 'cleaned' as stage, * from ({clean_sql})"


def _failures(flags: str, k: int) -> str:
    return (f"select rule_id, column_name, expectation, cast(sample_no as integer) as sample_no, customer_id, value "
            f"from (select *, row_number() over (partition by rule_id order by ord) as sample_no "
            f"from ({failures_long_sql(flags, SUITE, 'ord, customer_id')})) where sample_no <= {k}")


def _key_failures(flags: str, rules: list[Rule], key: str, k: int) -> str:
    return (f"select rule_id, column_name, expectation, cast(sample_no as integer) as sample_no, {key}, value "
            f"from (select *, row_number() over (partition by rule_id order by {key}) as sample_no "
            f"from ({failures_long_sql(flags, rules, key)})) where sample_no <= {k}")


def _failed_rows(flags: str, k: int) -> str:
    return (f"select rule_id, row_number from (select rule_id, pos as row_number, "
            f"row_number() over (partition by rule_id order by ord) as rk from ("
            + "\nunion all\n".join(f"select {r.rule_id} as rule_id, ord, pos from {flags} where u{r.rule_id}"
                                   for r in SUITE)
            + f")) where rk <= {k}")


def _orders_flags() -> str:
    return flags_cte("fo", "orders", orders_suite(), ORDERS_TYPES, "o_orderkey")


def _cleaning_log_body() -> str:
    return f"""
select cast(ordinal as integer) as ordinal, section, metric, cast(value as bigint) as value, status from (
  select 1 as ordinal, 'normalization' as section, 'phone_fixes' as metric, phone_fixes as value,
    cast(null as varchar) as status from st
  union all select 2, 'normalization', 'date_fixes', date_fixes, null from st
  union all select 3, 'normalization', 'name_fixes', name_fixes, null from st
  union all select 4, 'normalization', 'email_fixes', email_fixes, null from st
  union all select ordinal + 4, 'missing_values', column_name, missing_count, null from mc
  union all select 13, 'validation', 'failures_before', unsuccessful_expectations, null from vb
  union all select 14, 'validation', 'failures_after', unsuccessful_expectations,
    case when unsuccessful_expectations = 0 then 'PASS' else 'REVIEW REQUIRED' end from va
  union all select 15, 'output', 'rows', (select count(*) from cleaned), null
  union all select 16, 'output', 'columns', 10, null
  union all select 17, 'unparsed', 'date_of_birth', (select count(*) from ({DATE_REJECTS_SQL}) where column_name = 'date_of_birth'), null
  union all select 18, 'unparsed', 'created_date', (select count(*) from ({DATE_REJECTS_SQL}) where column_name = 'created_date'), null)"""


_LOG_CTES = (
    DIRTY, CLEANED, RAW_FLAGS, CLEAN_FLAGS,
    f"st as ({CLEAN_STATS_SQL})",
    f"mc as ({MISSING_COUNTS_SQL})",
    f"vb as ({summary_sql(evaluate_sql('fr', 'dirty', SUITE))})",
    f"va as ({summary_sql(evaluate_sql('fc', 'cleaned', SUITE))})",
)

_RUN_REPORT = with_(*_LOG_CTES, MASKED, f"pii as ({pii_scan_sql('cleaned')})") + """
select cast(ordinal as integer) as ordinal, stage, metric, cast(value as bigint) as value from (
  select 1 as ordinal, 'LOAD' as stage, 'rows' as metric, (select count(*) from dirty) as value
  union all select 2, 'LOAD', 'columns', 10
  union all select 3, 'VALIDATE (RAW)', 'failures', (select unsuccessful_expectations from vb)
  union all select 4, 'CLEAN', 'phone_fixes', (select phone_fixes from st)
  union all select 5, 'CLEAN', 'email_fixes', (select email_fixes from st)
  union all select 6, 'CLEAN', 'date_fixes', (select date_fixes from st)
  union all select 7, 'CLEAN', 'name_fixes', (select name_fixes from st)
  union all select 8, 'CLEAN', 'missing_fills', (select sum(missing_count) from mc)
  union all select 9, 'VALIDATE (CLEANED)', 'failures', (select unsuccessful_expectations from va)
  union all select 10, 'DETECT PII', 'emails', (select found_rows from pii where pii_type = 'email')
  union all select 11, 'DETECT PII', 'dobs', (select found_rows from pii where pii_type = 'dob')
  union all select 12, 'SAVE', 'masked_rows', (select count(*) from masked))"""


def _quarantine() -> str:
    failed = "concat_ws(',', " + ", ".join(f"case when u{r.rule_id} then '{r.rule_id}' end" for r in SUITE) + ")"
    n = " + ".join(f"cast(u{r.rule_id} as integer)" for r in SUITE)
    return with_(DIRTY, RAW_FLAGS) + (f"select {CUSTOMER_COLS}, {failed} as failed_rules, {n} as n_failed "
                                      f"from fr where {ANY_FAILED}")


#: The dirty table as it comes back from three files, in (file, line) order: the last 2 per cent of the keys, the bulk, the first tenth.
def _files() -> str:
    n = "(select max(c_custkey) + 1 from customer)"
    place = f"case when ord >= cast(floor(0.98::double * {n}) as bigint) then 0 when ord >= cast(floor(0.1::double * {n}) as bigint) then 1 else 2 end"
    return (f"all_keys as ({DIRTY_SQL}), in_file as (select *, row_number() over (order by {place}, ord) - 1 as line from all_keys), "
            f"dirty as ({_scan_csv('line as ord, ').replace('from dirty', 'from in_file')})")


def _by_segment() -> str:
    """The checks of the profile as legs over grouping sets."""
    legs = []
    for i, (c, t) in enumerate(CUSTOMER_COLUMNS, start=1):
        gone = f"{c} is null or isnan({c})" if t == "double" else f"{c} is null"
        legs.append(("COMPLETENESS", i, c, f"{gone} or contains(lower({c}), {q(DATE_SENTINEL)})" if t == "varchar" else gone))
    legs += [("DATA TYPES", 1, "date_of_birth", f"regexp_matches(date_of_birth, {q(DOB_DRIFT_PATTERN)})"),
             ("DATA TYPES", 2, "income", "income is null or isnan(income)"),
             ("QUALITY ISSUES", 1, "phone", f"regexp_matches(phone, {q(NONSTANDARD_PHONE_PATTERN)})"),
             ("QUALITY ISSUES", 2, "date_of_birth", "contains(date_of_birth, '/')"),
             ("QUALITY ISSUES", 2, "created_date", "contains(created_date, '/')"),
             ("QUALITY ISSUES", 3, "first_name", f"first_name is not null and not {is_title('first_name')}"),
             ("QUALITY ISSUES", 3, "last_name", f"last_name is not null and not {is_title('last_name')}"),
             ("QUALITY ISSUES", 4, "email", f"regexp_matches(email, {q(UPPERCASE_PATTERN)})"),
             ("QUALITY ISSUES", 5, "account_status", f"account_status is not null and lower(account_status) not in {STATUS_SET}")]
    sets = "grouping sets ((account_status, created_year), (account_status), (created_year), ())"
    parts = [f"select cast(grouping_id(account_status, created_year) as integer) as grouping_id, account_status, created_year, "
             f"{q(s)} as section, {i} as item_no, {q(c)} as column_name, count(*) filter (where {cond}) as affected, count(*) as total_rows "
             f"from seg group by {sets}" for s, i, c, cond in legs]
    keyed = sets.replace("())", "(customer_id))").replace("created_year)", "created_year, customer_id)").replace("(account_status)", "(account_status, customer_id)")
    parts.append(f"""select grouping_id, account_status, created_year, 'QUALITY ISSUES', 6, 'customer_id',
        cast(sum(case when n > 1 then n else 0 end) as bigint), cast(sum(n) as bigint) from (
        select cast(grouping_id(account_status, created_year) as integer) as grouping_id, account_status, created_year, customer_id, count(*) as n
        from seg group by {keyed}) group by all""")
    seg = f"seg as (select *, cast(left({iso('created_date')}, 4) as integer) as created_year from dirty)"
    return with_(DIRTY, seg) + "select *, cast(affected as double) / cast(total_rows as double) * 100.0 as affected_percent from (" + \
        "\nunion all\n".join(parts) + ")"


def _scan_csv(also: str = "") -> str:
    """What comes back from a CSV file: blanks after a delimiter go, except inside quotes; NaN is a missing value."""
    cols = []
    for c, t in CUSTOMER_COLUMNS:
        kept = f"if(regexp_matches({c}, '[,\"\n]'), {c}, ltrim({c}))"
        cols.append(f"if(isnan({c}), null, {c}) as {c}" if t == "double" else f"{kept} as {c}" if t == "varchar" else c)
    return f"select {also}{', '.join(cols)} from dirty"


def oracle_sql() -> dict[str, str]:
    d = with_(DIRTY)
    dc = with_(DIRTY, CLEANED)
    dcm = with_(DIRTY, CLEANED, MASKED)
    raw_flags = with_(DIRTY, CLEANED, RAW_FLAGS, CLEAN_FLAGS)
    pos_flags = with_(
        DIRTY, CLEANED,
        flags_cte("fr", "(select *, row_number() over (order by ord) as pos from dirty)", SUITE,
                  CUSTOMER_TYPES, "customer_id"),
        flags_cte("fc", "(select *, row_number() over (order by ord) as pos from cleaned)", SUITE,
                  CUSTOMER_TYPES, "customer_id"),
    )
    return {
        "scan_customers": d + f"select {CUSTOMER_COLS} from dirty",
        "scan_csv": d + _scan_csv(),
        "row_counts": d + "select count(*) as row_count, cast(10 as bigint) as column_count from dirty",
        "clean_names": d + f"select customer_id, {name_clean('first_name')} as first_name, "
                           f"{name_clean('last_name')} as last_name from dirty",
        "clean_emails": d + "select customer_id, lower(email) as email from dirty",
        "clean_phones": d + f"select customer_id, {phone_clean('phone')} as phone from dirty",
        "clean_dates": d + f"select customer_id, {date_clean('date_of_birth')} as date_of_birth, "
                           f"{date_clean('created_date')} as created_date from dirty",
        "clean_missing": d + """select customer_id, coalesce(first_name, '[UNKNOWN]') as first_name,
            coalesce(last_name, '[UNKNOWN]') as last_name, email, coalesce(phone, 'UNKNOWN') as phone,
            coalesce(date_of_birth, '[UNKNOWN]') as date_of_birth, coalesce(address, '[UNKNOWN]') as address,
            case when income is null or isnan(income) then 0.0 else income end as income,
            coalesce(account_status, 'unknown') as account_status,
            coalesce(created_date, '[UNKNOWN]') as created_date from dirty""",
        "clean_full": dc + f"select {CUSTOMER_COLS} from cleaned",
        "clean_stats": d + CLEAN_STATS_SQL,
        "clean_missing_counts": d + MISSING_COUNTS_SQL,
        "cleaning_log": with_(*_LOG_CTES) + _cleaning_log_body(),
        "mask_names": dcm + "select customer_id, first_name, last_name from masked",
        "mask_emails": dcm + "select customer_id, email from masked",
        "mask_phones": dcm + "select customer_id, phone from masked",
        "mask_addresses": dcm + "select customer_id, address from masked",
        "mask_dob": dcm + "select customer_id, date_of_birth from masked",
        "mask_full": dcm + f"select {CUSTOMER_COLS} from masked",
        "masked_sample": dcm + f"""select * from (select 'before' as side, {CUSTOMER_COLS} from dirty
            order by ord limit 2)
            union all select * from (select 'after' as side, {CUSTOMER_COLS} from masked order by ord limit 2)""",
        "validate_raw": with_(DIRTY, RAW_FLAGS) + evaluate_sql("fr", "dirty", SUITE),
        "validate_clean": with_(DIRTY, CLEANED, CLEAN_FLAGS) + evaluate_sql("fc", "cleaned", SUITE),
        "validate_summary": raw_flags + _stage_union(summary_sql(evaluate_sql("fr", "dirty", SUITE)),
                                                     summary_sql(evaluate_sql("fc", "cleaned", SUITE))),
        "validate_impact": raw_flags + _stage_union(
            f"select count(*) filter (where {ANY_FAILED}) as impacted_rows, count(*) as total_rows from fr",
            f"select count(*) filter (where {ANY_FAILED}) as impacted_rows, count(*) as total_rows from fc"),
        "validate_failures": raw_flags + _stage_union(_failures("fr", 3), _failures("fc", 3)),
        "validate_failed_rows": pos_flags + _stage_union(_failed_rows("fr", 10), _failed_rows("fc", 10)),
        "files_failures": with_(_files(), RAW_FLAGS) + _failures("fr", 3),
        "files_failed_rows": with_(_files(), flags_cte(
            "fr", "(select *, ord + 1 as pos from dirty)", SUITE, CUSTOMER_TYPES, "customer_id")) + _failed_rows("fr", 10),
        "files_masked_sample": with_(_files(), CLEANED, MASKED) + f"""select * from (select 'before' as side, {CUSTOMER_COLS} from dirty
            order by ord limit 2)
            union all select * from (select 'after' as side, {CUSTOMER_COLS} from masked order by ord limit 2)""",
        "validate_orders": with_(_orders_flags()) + evaluate_sql("fo", "orders", orders_suite()),
        "validate_orders_failures": (
            with_(flags_cte("fo", "orders", orders_key_suite(), ORDERS_TYPES, "o_orderkey"))
            + _key_failures("fo", orders_key_suite(), "o_orderkey", 3)),
        "validate_events": with_(flags_cte("fe", "events", events_suite(), EVENTS_TYPES, "event_id")) + evaluate_sql("fe", "events", events_suite()),
        "validate_events_impact": with_(flags_cte("fe", "events", events_suite(), EVENTS_TYPES, "event_id"))
            + f"select count(*) filter (where {_any(events_suite())}) as impacted_rows, count(*) as total_rows from fe",
        "quarantine_events": with_(flags_cte("fe", "events", events_suite(), EVENTS_TYPES, "event_id"))
            + "select event_id, concat_ws(',', " + ", ".join(f"case when u{r.rule_id} then '{r.rule_id}' end" for r in events_suite())
            + ") as failed_rules, cast(" + " + ".join(f"cast(u{r.rule_id} as integer)" for r in events_suite())
            + f" as integer) as n_failed from fe where {_any(events_suite())}",
        "profile_completeness": d + completeness_sql("dirty", CUSTOMER_COLUMNS),
        "profile_completeness_orders": completeness_sql("orders", ORDERS_COLUMNS),
        "profile_types": d + TYPES_SQL,
        "profile_issues": with_(DIRTY, ISSUES_SQL) + "select * from iss",
        "profile_slash_dates": d + SLASH_SQL,
        "profile_invalid_status": d + INVALID_STATUS_SQL,
        "profile_duplicates": d + ("select customer_id, count(*) as occurrences from dirty group by customer_id "
                                   "having count(*) > 1"),
        "profile_duplicates_orders": ("select o_custkey, count(*) as occurrences from orders group by o_custkey "
                                      "having count(*) > 1"),
        "profile_by_segment": _by_segment(),
        "profile_report": REPORT_SQL,
        "pii_scan": dc + pii_scan_sql("cleaned"),
        "pii_scan_raw": d + pii_scan_sql("dirty"),
        "pii_risk": dc + f"""select r.column_name, r.risk_level, s.pii_type, s.found_rows, s.total_rows
            from (values {RISK_VALUES}) r(column_name, risk_level)
            left join ({pii_scan_sql('cleaned')}) s on r.column_name = s.column_name""",
        "pii_scan_documents": text_scan_sql("documents", "text"),
        "pii_scan_by_source": text_scan_wide_sql("documents", "text", ("lang", "source")),
        "pii_scan_conversations": text_scan_wide_sql("conversations", "text", ("role",)),
        "pii_scan_pages": text_scan_sql("pages", "html"),
        "mask_documents": f"""select doc_id, regexp_replace(regexp_replace(text, {q(EMAIL_PATTERN)}, '[EMAIL]', 'g'),
            {q(PHONE_PATTERN)}, '[PHONE]', 'g') as text from documents""",
        "run_report": _RUN_REPORT,
        "run_summary": with_(DIRTY, CLEANED, MASKED, CLEAN_FLAGS) + """select (select count(*) from dirty) as input_rows,
            (select count(*) from masked) as output_rows,
            (select case when bool_and(success) then 'PASS' else 'FAIL' end from (""" +
            evaluate_sql("fc", "cleaned", SUITE) + """)) as quality_status,
            'SUCCESS' as execution_status""",
        "clean_date_rejects": d + DATE_REJECTS_SQL,
        "quality_gate": with_(DIRTY, RAW_FLAGS) + f"""select rule_id, column_name, expectation, share as failed_share, threshold,
            coalesce(share >= threshold, false) as halts from (select e.*, unexpected_count / nullif(element_count, 0)::double as share
              from ({evaluate_sql("fr", "dirty", SUITE)}) e)
            join (values (2, 0.5::double), (4, 0.05::double), (7, 0.1::double), (12, 0.2::double)) t(rule_id, threshold)
            using (rule_id)""",
        "published_masked": dcm + f"select {CUSTOMER_COLS} from masked",
        "quarantine": _quarantine(),
        "sql_mask_full": dcm + f"select {CUSTOMER_COLS} from masked",
        "sql_rule_report": raw_flags.rstrip() + f""" select r.rule_id, r.column_name, r.unexpected_count as before, c.unexpected_count as after,
            m.missing_count from ({evaluate_sql('fr', 'dirty', SUITE)}) r join ({evaluate_sql('fc', 'cleaned', SUITE)}) c on r.rule_id = c.rule_id
            left join ({completeness_sql('dirty', CUSTOMER_COLUMNS)}) m on m.column_name = r.column_name
            where r.unexpected_count > 0 or c.unexpected_count > 0""",
        "stream_mask_customers": dcm + f"select {CUSTOMER_COLS} from masked",
        "stream_duplicate_keys": ("select o_custkey, count(*) as occurrences from orders group by o_custkey "
                                  "having count(*) > 1"),
        "stream_unique_events": """with e as (select event_id, user_id, event_type, epoch_us(ts) as t, coalesce(event_id % 97 = 0, false) as straggler from events),
            m as (select coalesce(max(t) filter (where not straggler) // 1000 - 6 * 3600 * 1000, 0) as watermark from e),
            p as (select e.*, coalesce(straggler and t // 1000 < watermark, false) as late from e, m),
            j as (select event_id, user_id is not null and event_type is not null
                and (coalesce(t - lag(t) over w <= 3600000000, false) or coalesce(lead(t) over w - t <= 3600000000, false)) as failed
                from p where not late window w as (partition by user_id, event_type order by t))
            select event_id, failed from j union all select event_id, null from p where late""",
        "cross_field": dc + """select customer_id, date_of_birth, created_date,
            try_strptime(date_of_birth, '%Y-%m-%d') is not null
              and try_strptime(created_date, '%Y-%m-%d') is not null as checked,
            coalesce(try_strptime(created_date, '%Y-%m-%d') <= try_strptime(date_of_birth, '%Y-%m-%d'), false)
              as violated
            from cleaned""",
    }
