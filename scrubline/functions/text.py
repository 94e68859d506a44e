"""Column -> Column text helpers built only from native Spark expressions.

None of these use a Python UDF: each returns a Catalyst expression, so the work
stays in the JVM and is planned/pruned like any other projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cache import cached_expr
from .patterns import MONTH_NAMED, PY_SPACE_CHARS, TIME_OF_DAY, TWO_DIGIT_YEAR_PIVOT, WEEKDAY, YEAR_FIRST, YEAR_LAST

# A "cased" run is a maximal run of upper/lower/title-case letters; everything
# else (digits, punctuation, blanks, uncased scripts) separates words.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_WORD_START = rf"([^{_CASED} ])(?=[{_CASED}])"  # blanks already start words in initcap
_MARK = "\u0000 "
_PLAIN_TITLE = r"^[A-Z][a-z]*( [A-Z][a-z]*)*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cached_expr
def strip(c: Column | str) -> Column:
    """Remove leading/trailing whitespace (Unicode aware, unlike ``trim``):
    every character Python's ``str.strip()`` removes, without a regex."""
    return F.btrim(_col(c), F.lit(PY_SPACE_CHARS))


@cached_expr
def title(c: Column | str) -> Column:
    """Title-case: the first cased letter after any uncased character is
    title-cased, every other letter lower-cased (Python ``str.title``).

    ``initcap`` alone only starts words after a blank (``O'BRIEN`` ->
    ``O'brien``).  So a marker ending in a blank is first inserted after every
    uncased character that precedes a cased one, ``initcap`` then starts a word
    there, and the markers are removed: ``o'brien`` -> ``O'Brien``,
    ``mary-jane`` -> ``Mary-Jane``, ``3rd`` -> ``3Rd``.  All three steps are
    expressions with generated code (a lambda over ``regexp_extract_all``
    would force interpreted evaluation), and ``initcap`` title-cases letters
    the way Python does (``ß``, ``ǆ``, ligatures).  Null stays null.
    Text that already contains the marker (U+0000 followed by a blank) is not
    supported.
    """
    c = _col(c)
    marked = F.regexp_replace(c, _WORD_START, "$1" + _MARK)
    slow = F.regexp_replace(F.initcap(marked), _MARK, "")
    # exact fast path: blank-separated ASCII words that are already title-cased
    return F.when(c.rlike(_PLAIN_TITLE), c).otherwise(slow)


@cached_expr
def is_title(c: Column | str) -> Column:
    """True when the value is already title-cased and has at least one cased letter."""
    c = _col(c)
    return (title(c) == c) & c.rlike(f"[{_CASED}]")


@cached_expr
def parse_date(c: Column | str) -> Column:
    """Parse mixed-layout date text to a DATE (null when nothing matches).

    The grammar of ``patterns`` in native expressions: time and weekday are cut off, then the
    text has one of three shapes, each a regex whose rewrite puts year, month and day
    in order; casts and parses never throw under ANSI mode and check the calendar.  Names
    are accepted in any letter case.  Text of no shape is null without any parse.
    """
    return parse_date_core(date_core(F.trim(_col(c))))


def date_core(t: Column) -> Column:
    """Trimmed date text without its time of day and weekday."""
    timeless = F.when(t.contains(":"), F.regexp_replace(t, TIME_OF_DAY, "")).otherwise(t)
    return F.when(t.rlike("[A-Za-z]"), F.regexp_replace(F.lower(timeless), WEEKDAY, "")).otherwise(timeless)


def parse_date_core(d: Column) -> Column:
    """``parse_date`` for what ``date_core`` gives.  ``d`` is referenced by
    every shape test, so callers should pass a column computed in an earlier
    projection rather than an expression (see ``clean.clean``)."""
    century = F.when(F.substring(d, -2, 2) >= F.lit(f"{TWO_DIGIT_YEAR_PIVOT:02d}"), F.lit("19")).otherwise(F.lit("20"))

    def full(ymd: Column) -> Column:
        """Year-month-day text with a year of four digits."""
        return F.when(F.substring(ymd, 3, 1) == "-", F.concat(century, ymd)).otherwise(ymd)

    month_first, day_first = (full(F.regexp_replace(d, YEAR_LAST[0], r)).try_cast("date") for r in YEAR_LAST[1])
    return (F.when(d.rlike(YEAR_FIRST[0]), F.regexp_replace(d, *YEAR_FIRST).try_cast("date"))
            .when(d.rlike(YEAR_LAST[0]), F.coalesce(month_first, day_first))
            .when(d.rlike(MONTH_NAMED[0]), F.try_to_date(full(F.regexp_replace(d, *MONTH_NAMED)), "yyyy-MMM-d")))


@cached_expr
def iso_date(c: Column | str) -> Column:
    """Mixed-layout date text -> ``YYYY-MM-DD`` text (null when unparseable)."""
    return F.date_format(parse_date(c), "yyyy-MM-dd")


def py_repr(v: Column) -> Column:
    """Render a string the way Python's ``repr`` does: single quotes, or double quotes around
    text that holds single quotes only; backslashes, line breaks and tabs escaped."""
    s = F.replace(v, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(raw), F.lit(shown))
    double = v.contains("'") & ~v.contains('"')
    return F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'")))


def py_list_repr(arr: Column) -> Column:
    """Render an array<string> the way a Python list of str prints: ``['a', "it's"]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, py_repr), ", "), F.lit("]"))
