"""Scalar helpers against Python's own string semantics."""

import pytest

from scrubline.functions.text import is_title, iso_date, strip, title

NAMES = ["john", "O'BRIEN", "mary-jane", "  x y ", "", "éCOLE dé", "3rd street", "hello WORLD",
         "abc1def", "Sarah", " Wilson\t", "ŁÓDŹ", "日本 name", "x "]


def test_title_and_strip_match_python(spark):
    df = spark.createDataFrame([(v,) for v in NAMES], "v string")
    got = {r.v: (r.t, r.it) for r in df.select("v", title(strip("v")).alias("t"), is_title("v").alias("it")).collect()}
    for v in NAMES:
        assert got[v][0] == v.strip().title(), v
        assert got[v][1] == v.istitle(), v


def test_title_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(title("v")).first()[0] is None


@pytest.mark.parametrize("raw,expected", [
    ("2024-01-10", "2024-01-10"),
    ("1975/05/10", "1975-05-10"),
    ("01/15/2024", "2024-01-15"),
    ("15/01/2024", "2024-01-15"),   # day-first only when month-first is impossible
    ("01/02/2024", "2024-01-02"),   # month-first wins when ambiguous
    ("2024-1-5", "2024-01-05"),
    ("JAN 5, 2024", "2024-01-05"),
    ("5 January 2024", "2024-01-05"),
    ("2024-01-15 10:30:00", "2024-01-15"),
    ("20240110", "2024-01-10"),
    ("2024-02-30", None),           # not a calendar date
    ("1/5/85", "1985-01-05"),       # two-digit years: explicit pivot
    ("invalid_date", None),
    ("[UNKNOWN]", None),
    (None, None),
])
def test_iso_date(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(iso_date("v")).first()[0] == expected


def test_title_property_against_python(spark):
    """Random strings over cased, uncased and whitespace characters.

    Known difference: Java lower-cases a word-final capital sigma to the final
    form, Python does not; strings with a capital sigma are left out.
    """
    import random

    rnd = random.Random(11)
    alphabet = (list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") + list("éÉèàçÇßøØłŁñÑ")
                + list(" -'.,0123456789_/()\t") + ["日", "本", "ǆ", "ı", "σ", "ﬁ", " "])
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select("v", title("v").alias("t"), strip("v").alias("s")).collect()
    assert [r.v for r in rows if r.t != r.v.title()] == []
    assert [r.v for r in rows if r.s != r.v.strip()] == []


@pytest.mark.parametrize("text,iso", [
    ("1/5/24", "2024-01-05"), ("1/5/85", "1985-01-05"), ("25-12-68", "2068-12-25"), ("25-12-69", "1969-12-25"),
    ("2024-01-15 10:30", "2024-01-15"), ("2024-01-15 10:00:00.123", "2024-01-15"), ("2024/01/15 10:00:00", "2024-01-15"),
    ("1/15/2024 10:30", "2024-01-15"), ("1/15/2024 9:05 PM", "2024-01-15"), ("2024-01-15T10:30:00Z", "2024-01-15"),
    ("2024-01-15T10:30:00+02:00", "2024-01-15"), ("Jan 15 2024", "2024-01-15"), ("15 Jan, 2024", "2024-01-15"),
    ("january 15, 2024", "2024-01-15"), ("2024-02-30", None), ("10:30", None), ("13/13/24", None), ("someday", None),
    ("2024-01-15 25:00", None),
])
def test_more_date_layouts(spark, text, iso):
    from scrubline.functions.text import iso_date
    assert spark.createDataFrame([(text,)], "d string").select(iso_date("d")).first()[0] == iso


@pytest.mark.parametrize("text,iso", [
    ("15.01.2024", "2024-01-15"), ("05.01.2024", "2024-05-01"), ("15-Jan-24", "2024-01-15"), ("Jan-15-2024", "2024-01-15"),
    ("2024-Jan-15", "2024-01-15"), ("15 Jan 24", "2024-01-15"), ("15th January 2024", "2024-01-15"), ("1st of May 1999", "1999-05-01"),
    ("Monday, January 15, 2024", "2024-01-15"), ("Mon 15 Jan 2024 10:30:00 GMT", "2024-01-15"), ("Sept 5 2024", "2024-09-05"),
    ("15JAN2024", "2024-01-15"), ("15/jan/2024", "2024-01-15"), ("January 15th, 2024", "2024-01-15"), ("2024 january 5", "2024-01-05"),
    ("5 January 2024, Friday", "2024-01-05"), ("sun 01/15/2024", "2024-01-15"), ("2024 1 15", "2024-01-15"), ("15-Jan-70", "1970-01-15"),
    ("30 Feb 2024", None), ("Janember 5 2024", None), ("Marching 5 2024", None), ("Jan152024", None), ("sunny 01/15/2024", None),
    ("monday", None), ("2024", None), ("2024-01", None), ("1-5/85", None), ("2024-01/15", None), ("32nd May 2024", None), ("#2024-01-15", None),
    ("Dec 0 2024", None), ("10:30 Jan 15 2024", None), ("15 Jan 024", None), ("", None), ("|", None),
])
def test_date_grammar(spark, text, iso):
    assert spark.createDataFrame([(text,)], "d string").select(iso_date("d")).first()[0] == iso


def test_date_grammar_against_a_general_parser(spark):
    """Every day written in every layout is the day that dateutil reads (month first where both would do)."""
    import datetime as dt
    import random

    parser = pytest.importorskip("dateutil.parser")
    rnd, texts = random.Random(3), []
    for _ in range(150):
        day = dt.date(1950, 1, 1) + dt.timedelta(days=rnd.randrange(36_000))
        d, y = day.day, day.year
        nth = f"{d}{'th' if 10 < d % 100 < 14 else {1: 'st', 2: 'nd', 3: 'rd'}.get(d % 10, 'th')}"
        for m in (f"{day:%b}", f"{day:%B}"):
            texts += [f"{d} {m} {y}", f"{d}-{m}-{y}", f"{m} {d}, {y}", f"{m}-{d}-{y}", f"{y}-{m}-{d}", f"{nth} {m} {y}", f"{day:%A}, {m} {d}, {y}",
                      f"{day:%a} {d} {m.upper()} {y}", f"{d}{m}{y}", f"{nth} of {m} {y}", f"{m} {nth} {y}", f"{d} {m} {y} 10:30:00"]
        texts += [f"{day}", f"{day:%Y/%m/%d}", f"{day:%Y.%m.%d}", f"{day:%Y%m%d}", f"{day:%m/%d/%Y}", f"{day:%d/%m/%Y}", f"{day:%d.%m.%Y}",
                  f"{day:%m-%d-%Y}", f"{day:%d-%m-%Y}", f"{day:%m/%d/%Y} 9:05 PM", f"{day}T10:30:00Z"]
    got = {r.d: r.iso for r in spark.createDataFrame([(t,) for t in texts], "d string").select("d", iso_date("d").alias("iso")).collect()}
    assert {t: v for t, v in got.items() if v != parser.parse(t).date().isoformat()} == {}


def test_python_repr(spark):
    from scrubline.functions.text import py_list_repr
    values = ["a", "it's", 'say "hi"', "both ' and \"", "back\\slash", "line\nbreak\ttab"]
    df = spark.createDataFrame([(values,)], "v array<string>")
    assert df.select(py_list_repr(df.v)).first()[0] == repr(values)
