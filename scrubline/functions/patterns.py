"""Fixed values that must equal the behaviour being reproduced.

Everything in this module is a constant: patterns, token lists, fill values,
rule bounds and format lists.  They are written out plainly so that they can
be compared by eye with the behaviour they reproduce.

Regex dialect notes
-------------------
Spark evaluates ``rlike`` / ``regexp_*`` with ``java.util.regex``.  The
patterns below avoid the shorthand classes ``\\d`` and ``\\s`` because their
meaning differs between Python (Unicode aware), Java (ASCII) and RE2 (ASCII,
no vertical tab).  ``\\p{Nd}`` is the Python meaning of ``\\d`` and
``PY_SPACE`` spells out the Python meaning of ``\\s``; both engines used here
(Java, RE2) accept the exact same text, so the DuckDB oracles can reuse it.
"""

# --- fixed values: PII detection patterns ----------------------------------
# e-mail, as written:  [a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
# the same matches from Java's leftmost search, in linear time: a match can only start where the
# previous one ended or where no character of the local part stands before it, so a run of n such
# characters is tried once instead of n times
EMAIL_PATTERN_LINEAR = r"(?:\G|(?<![a-zA-Z0-9._%+-]))" + EMAIL_PATTERN

# Python's \s for str patterns (Unicode White_Space plus the \x1c-\x1f separators)
PY_SPACE = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
PY_DIGIT = r"\p{Nd}"
# the same 29 characters as a plain string (for trimming without a regex)
PY_SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# phone, as written:  (\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}
_SEP = r"[-." + PY_SPACE[1:-1] + r"]"
PHONE_PATTERN = (
    r"(\+?" + PY_DIGIT + r"{1,3}" + _SEP + r"?)?\(?" + PY_DIGIT + r"{3}\)?"
    + _SEP + r"?" + PY_DIGIT + r"{3}" + _SEP + r"?" + PY_DIGIT + r"{4}"
)

# --- fixed values: cleaning -------------------------------------------------
DATE_SENTINEL = "invalid_date"
# ISO check used when counting date fixes:  ^\d{4}-\d{2}-\d{2}$
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# a formatted phone:  ^\d{3}-\d{3}-\d{4}$
FORMATTED_PHONE_PATTERN = r"^[0-9]{3}-[0-9]{3}-[0-9]{4}$"
# as written:  \D  (of ASCII text)
NON_DIGIT_PATTERN = r"[^0-9]"

# placeholders written by the missing-value step, in column order of the fill map
FILL_VALUES = {
    "first_name": "[UNKNOWN]",
    "last_name": "[UNKNOWN]",
    "address": "[UNKNOWN]",
    "date_of_birth": "[UNKNOWN]",
    "phone": "UNKNOWN",
    "created_date": "[UNKNOWN]",
    "account_status": "unknown",
    "income": 0.0,
}
NAME_COLUMNS = ("first_name", "last_name")
DATE_COLUMNS = ("date_of_birth", "created_date")

# --- fixed values: masking --------------------------------------------------
NAME_PLACEHOLDER = "[UNKNOWN]"
NAME_MASK_SUFFIX = "***"
EMAIL_MASK_INFIX = "***@"
PHONE_MASK_PREFIX = "***-***-"
PHONE_MASK_FULL = "***-***-****"
ADDRESS_MASK = "[MASKED ADDRESS]"
DOB_MASK_SUFFIX = "-**-**"
EMAIL_TEXT_TOKEN = "[EMAIL]"
PHONE_TEXT_TOKEN = "[PHONE]"

# --- fixed values: profiling ------------------------------------------------
VALID_STATUSES = ("active", "inactive", "suspended")
DECLARED_TYPES = (
    ("customer_id", "INT"),
    ("first_name", "STRING"),
    ("last_name", "STRING"),
    ("email", "STRING"),
    ("phone", "STRING"),
    ("address", "STRING"),
    ("account_status", "STRING"),
)
DOB_DRIFT_PATTERN = r"/|invalid"
# as written:  [\.\(\)]
NONSTANDARD_PHONE_PATTERN = r"[.()]"
UPPERCASE_PATTERN = r"[A-Z]"
SLASH = "/"

# --- fixed values: PII risk levels ------------------------------------------
RISK_LEVELS = (
    ("first_name", "HIGH"),
    ("last_name", "HIGH"),
    ("email", "HIGH"),
    ("phone", "HIGH"),
    ("address", "HIGH"),
    ("date_of_birth", "HIGH"),
    ("income", "MEDIUM"),
)
ADDRESS_MIN_LENGTH = 5  # an address counts when its length is greater than this

# --- fixed values: validation suite bounds ----------------------------------
NAME_LENGTH_BOUNDS = (2, 50)
# as written:  ^[a-zA-Z\s]+$
NAME_PATTERN = r"^[a-zA-Z" + PY_SPACE[1:-1] + r"]+$"
INCOME_BOUNDS = (0, 10_000_000)
CUSTOMER_ID_MIN = 1

# --- fixed values: names of the rules in results ------------------------------
EXPECTATION_NAMES = {
    "not_null": "expect_column_values_to_not_be_null",
    "unique": "expect_column_values_to_be_unique",
    "between": "expect_column_values_to_be_between",
    "length_between": "expect_column_value_lengths_to_be_between",
    "regex": "expect_column_values_to_match_regex",
    "in_set": "expect_column_values_to_be_in_set",
    "date_format": "expect_column_values_to_match_strftime_format",
    "date_order": "expect_column_pair_values_a_to_be_greater_than_b",
}

# --- fixed values: titles of the profile issues, by check number ---------------
ISSUE_TITLES = {
    1: "Non-standard Phone Formats",
    2: "Inconsistent Date Formats (Slashes detected)",
    3: "Inconsistent Name Casing",
    4: "Non-standard Email Casing (Uppercase detected)",
    5: "Invalid Category Values",
    6: "Duplicate Customer IDs detected.",
}

# --- fixed values: CSV missing-value tokens (pandas read_csv defaults) ------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: the grammar of dates --------------------------------------
# A date is made of tokens: numbers, a month name, an ordinal ending, a weekday, separators,
# and a time of day with its zone.  A time (a blank or T, hours and minutes, seconds and their
# fractions if given, a zone if given) and a weekday say nothing about the date and are cut off; the
# date is that of the text's own zone.  What is left has one of three shapes:
#   year first        2024-01-15  2024/1/5  2024.01.15  20240115
#   two small numbers 01/15/2024  15.01.2024  1-5-85     month first, as the mixed-format parser
#                                                        guesses, then day first
#   a month name      15 Jan 2024  15-Jan-24  15th of January 2024  Jan-15-2024  2024-Jan-15  15jan2024
TIME_OF_DAY = (r"[ T]+([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?( ?([AaPp][Mm]))?"
               r"( ?(Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?$")
_WEEKDAY = r"(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?"
WEEKDAY = rf"^{_WEEKDAY}[,. ]+|[,. ]+{_WEEKDAY}$"
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# the first three letters of a month name: written out, cut to three letters, or "sept"
_MONTH = "(?=(?:" + "|".join(MONTH_NAMES) + "|" + "|".join(m[:3] for m in MONTH_NAMES) + "|sept)(?![a-z]))([a-z]{3})[a-z]*"
_DAY, _SMALL, _YEAR, _SEP = "([0-9]{1,2})(?:st|nd|rd|th)?", "([0-9]{1,2})", "([0-9]{4}|[0-9]{2})", "[-/., ]"
# (shape, rewrite to year-month-day text)
YEAR_FIRST = (rf"^([0-9]{{4}})([-/. ]){_SMALL}\2{_SMALL}$|^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})$", "$1$5-$3$6-$4$7")
YEAR_LAST = (rf"^{_SMALL}([-/. ]){_SMALL}\2{_YEAR}$", ("$4-$1-$3", "$4-$3-$1"))
MONTH_NAMED = (rf"^{_DAY}{_SEP}*(?:of +)?{_MONTH}{_SEP}*{_YEAR}$|^{_MONTH}{_SEP}*{_DAY}{_SEP}+{_YEAR}$|^([0-9]{{4}}){_SEP}*{_MONTH}{_SEP}*{_DAY}$",
               "$3$6$7-$2$4$8-$1$5$9")
# two-digit years from the pivot on are 19xx, others 20xx
TWO_DIGIT_YEAR_PIVOT = 69
