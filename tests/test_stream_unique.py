"""Uniqueness in a stream: flags that are taken back, late rows, state that ends, restarts."""

import datetime as dt
import os
import random
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from scrubline.plans.catalog import QUERIES
from scrubline.plans.oracles import oracle_sql
from scrubline.streaming.incremental import file_stream
from scrubline.streaming.unique import arrive, flag_rows_within, keyless_rows, late_rows, latest_flags, run_unique

START = dt.datetime(2024, 3, 31)  # a day on which many zones lose an hour
SCHEMA = "id long, k string, k2 long, t timestamp_ntz"


def put(spark, folder, rows):
    spark.createDataFrame([(i, k, k2, None if s is None else START + dt.timedelta(seconds=s)) for i, k, k2, s in rows], SCHEMA) \
        .coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, delay, horizon=60, **how):
    return run_unique(file_stream(spark, folder, "*.parquet", 1), "id", ["k", "k2"], "t", horizon, delay, out, **how)


def flags(spark, found):
    return {int(r.row_id): r.failed for r in latest_flags(spark, found["flags"]).collect()}


def expected(spark, folder):
    df = flag_rows_within(spark.read.parquet(folder), ["k", "k2"], "t", 60)
    return {r.id: r.failed for r in df.where("k is not null and k2 is not null and t is not null").collect()}


def test_flags_equal_the_batch_rule_after_every_arrival(spark, tmp_dir):
    """In any order of arrival; a partner that comes later takes the first flag back; a restart goes on."""
    rng = random.Random(5)
    rows = [(i, rng.choice("abc"), rng.randrange(3), rng.randrange(4000)) for i in range(240)]
    rows += [(1000 + i, "hot", 1, 5 * i) for i in range(200)]               # one key, one chain
    rows += [(2000, None, 1, 5), (2001, "a", None, 5), (2002, "a", 1, None)]  # cannot fail
    rows += [(3000, "pair", 1, 100), (3001, "pair", 1, 160), (3002, "pair", 1, 221), (3003, "x", 1, 7), (3004, "x", 1, 7)]
    rng.shuffle(rows)
    folder, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    changed, before = 0, {}
    for part in (rows[:100], rows[100:300], rows[300:]):
        put(spark, folder, part)
        found = run(spark, folder, out, delay=100_000, compact_every=2)  # nothing is late
        now = flags(spark, found)
        assert now == expected(spark, folder)
        changed += sum(now[i] and not f for i, f in before.items())
        assert all(now[i] or not f for i, f in before.items())
        before = now
    assert changed > 10
    assert flags(spark, found)[3001] and not flags(spark, found)[3002]  # 60 seconds are within, 61 are not
    assert late_rows(spark, found["late"]).count() == 0


def test_late_rows_and_state_that_ends(spark, tmp_dir):
    folder, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    put(spark, folder, [(i, f"key{i}", 1, i) for i in range(50)])
    run(spark, folder, out, delay=30)
    put(spark, folder, [(100 + i, f"other{i}", 1, 10_000 + i) for i in range(10)])
    run(spark, folder, out, delay=30)
    # the watermark stands at 9,979: the first keys are behind it, and so is the state of theirs
    put(spark, folder, [(200, "key1", 1, 1), (201, "other1", 1, 9_978), (202, "other2", 1, 9_980), (203, "new", 1, 9_979)])
    found = run(spark, folder, out, delay=30)
    assert {int(r.row_id): r.row_key for r in late_rows(spark, found["late"]).collect()} == {200: '["key1","1"]', 201: '["other1","1"]'}
    got = flags(spark, found)
    assert {i for i, f in got.items() if f} == {102, 202}
    assert set(got) == set(range(50)) | set(range(100, 110)) | {202, 203}
    assert found["state_rows"] <= 4 * 11  # the value and timers of the eleven open keys; fifty are gone


def test_many_keys_share_a_few_state_rows(spark, tmp_dir):
    """Keys of one bucket are judged apart, and calls and state rows do not grow with the keys."""
    rng = random.Random(7)
    rows = [(i, f"key{rng.randrange(300)}", 1, rng.randrange(2000)) for i in range(900)]
    folder, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    for part in (rows[:500], rows[500:]):
        put(spark, folder, part)
        found = run(spark, folder, out, delay=100_000, buckets=16)
        now = flags(spark, found)
        assert now == expected(spark, folder)
        assert found["state_rows"] <= 16
    assert 0 < sum(now.values()) < 900
    put(spark, folder, [(2000, "key1", 1, 300_000)])  # the watermark leaves all others behind
    assert run(spark, folder, out, delay=100_000, buckets=16)["state_rows"] == 1


def test_every_row_is_reported_once(spark, tmp_dir):
    """Null keys and times, null and repeated ids, over folded reports and restarts; the watermark sees rows without a key."""
    folder, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")

    def now():
        found = run(spark, folder, out, delay=30, compact_every=2, buckets=2)
        return (Counter((r.row_id, r.failed) for r in latest_flags(spark, found["flags"]).collect()),
                Counter(r.row_id for r in keyless_rows(spark, found["keyless"]).collect()),
                Counter((r.row_id, r.row_key) for r in late_rows(spark, found["late"]).collect()))

    put(spark, folder, [(1, "a", 1, 0), (1, "a", 1, 0), (1, "b", 1, 0), (1, "c", 1, 500), (None, "d", 1, 500), (None, "e", 1, 500),
                        (2, None, 1, 5), (2, None, 1, 5), (3, "a", None, 5), (4, "a", 1, None), (None, None, 1, 1), (5, None, None, None)])
    flags_, keyless, late = now()
    assert flags_ == {("1", True): 2, ("1", False): 2, (None, False): 2}
    assert keyless == {"2": 2, "3": 1, "4": 1, None: 1, "5": 1} and not late
    # the watermark stands at 470; a partner of two rows, and rows without a key behind it
    put(spark, folder, [(6, "c", 1, 510), (7, "d", 1, 510), (8, None, 1, 469), (8, None, 1, 469), (9, None, 1, 470), (10, "a", 1, 0), (11, None, 1, 10_000)])
    flags_, keyless, late = now()
    assert flags_ == {("1", True): 3, ("1", False): 1, (None, False): 1, (None, True): 1, ("6", True): 1, ("7", True): 1}
    assert keyless == {"2": 2, "3": 1, "4": 1, None: 1, "5": 1, "9": 1, "11": 1}
    assert late == {("8", None): 2, ("10", '["a","1"]'): 1}
    put(spark, folder, [(12, "c", 1, 9_969), (13, "c", 1, 9_970)])
    again, _, late = now()
    assert again == flags_ | {("13", False): 1}
    assert late == {("8", None): 2, ("10", '["a","1"]'): 1, ("12", '["c","1"]'): 1}


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string"


def test_query_has_every_event(spark, tmp_dir):
    """Events with nulls in any column and events that come twice: as many rows as events, equal to the SQL."""
    rng = random.Random(3)
    rows = [(i, START + dt.timedelta(seconds=rng.randrange(90_000)), rng.randrange(9), rng.choice("xyz")) for i in range(400)]
    rows = [tuple(None if rng.random() < 0.06 else v for v in r) for r in rows]
    rows += rng.sample(rows, 40) + [(97, START, None, "x"), (97, None, 1, "x"), (194, START, 1, None), (194, START, 1, "x"), (194, START, 1, "x")]
    spark.createDataFrame(rows, EVENTS).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    got = Counter(map(tuple, QUERIES["stream_unique_events"](spark, tmp_dir).select("event_id", "failed").collect()))
    with duckdb.connect() as duck:
        duck.execute(f"create view events as select * from read_parquet('{tmp_dir}/events.parquet/*.parquet')")
        want = Counter(duck.execute(f"select event_id, failed from ({oracle_sql()['stream_unique_events']})").fetchall())
    assert got.total() == len(rows) and got == want
    assert Counter(i for i, _ in got.elements()) == Counter(r[0] for r in rows)
    assert {f for _, f in got} == {True, False, None}


def test_every_event_arrives(spark, tmp_dir):
    """Also the last of a long time, one without a time and one without an id."""
    rows = [(1, dt.datetime(1970, 1, 1), 1, "x"), (2, dt.datetime(9999, 12, 31), 1, "x"), (97, START, 1, "x"), (3, None, 1, "x"), (None, START, 1, "x")]
    spark.createDataFrame(rows, EVENTS).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    folder = os.path.join(tmp_dir, "in")
    seen = [Counter(map(tuple, spark.read.parquet(folder).collect())) for _ in arrive(spark, tmp_dir, folder)]
    assert [s.total() for s in seen] == [3, 4, 5] and seen[-1] == Counter(rows)


def test_batch_rule_ignores_the_session_zone(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "in")
    put(spark, folder, [(1, "a", 1, 3600), (2, "a", 1, 3600 * 3), (3, "b", 1, 7195), (4, "b", 1, 7205)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert expected(spark, folder) == {1: False, 2: False, 3: True, 4: True}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_flags_are_columns_of_the_table(spark):
    df = spark.createDataFrame([(1, None)], "k long, t timestamp")
    assert flag_rows_within(df, ["k"], "t", 5, "again").select(F.col("again")).first()[0] is False
