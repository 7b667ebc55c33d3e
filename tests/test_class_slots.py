"""Turns in slots of their class: slots cut into calendar pieces, compared
with a plain test of every slot."""

import random
from bisect import bisect_right
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from learnscope.operators import features as fe

SLOT = "class_id long, open_at timestamp_ntz, close_at timestamp_ntz"
TURN = "turn_id long, session_class_id long, asked_at timestamp_ntz"
T0 = datetime(2019, 11, 3, 7, 30)


def _brute(turns, slots):
    """Per class, openings in order and the furthest close so far."""
    by = {}
    for c, o, x in sorted((s for s in slots if None not in s and s[1] <= s[2])):
        opens, reach = by.setdefault(c, ([], []))
        opens.append(o)
        reach.append(max(x, reach[-1]) if reach else x)
    out = {}
    for t, c, at in turns:
        k = bisect_right(by[c][0], at) if c in by and at is not None else 0
        out[t] = int(k > 0 and by[c][1][k - 1] >= at)
    return out


def _check(spark, turns, slots):
    got = fe.mark_in_class(spark.createDataFrame(turns, TURN), spark.createDataFrame(slots, SLOT)).collect()
    assert len(got) == len(turns)
    assert {r["turn_id"]: r["in_slot"] for r in got} == _brute(turns, slots)


def test_random_slots_of_minutes_to_decades(spark):
    rng = random.Random(5)
    slots, edges = [], []
    for i in range(600):
        o = T0 + timedelta(days=rng.randrange(9000), minutes=rng.randrange(1440))
        x = o + timedelta(minutes=int(10 ** rng.uniform(0, 6.6)))
        c = rng.randrange(90)
        slots.append((c, o, x))
        edges += [(c, at) for at in (o, x, o - timedelta(microseconds=1), x + timedelta(microseconds=1))]
    slots += slots[:50] + [(None, T0, T0), (1, None, T0), (2, T0, None), (3, T0 + timedelta(days=1), T0)]
    points = [(rng.randrange(95), T0 + timedelta(days=rng.randrange(-50, 9500), minutes=rng.randrange(1440))) for _ in range(3000)]
    _check(spark, [(i, c, at) for i, (c, at) in enumerate(edges + points + [(None, T0), (4, None)])], slots)


def test_slots_that_end_on_calendar_edges(spark):
    d = datetime
    slots = [(1, d(2020, 1, 1), d(2020, 12, 31, 23, 59, 59)), (2, d(2020, 1, 31), d(2020, 3, 1)), (3, d(2019, 12, 31), d(2022, 1, 1)),
             (4, d(2020, 2, 29, 12), d(2020, 2, 29, 12)), (5, d(2020, 1, 15), d(2021, 1, 15)), (6, d(2020, 1, 1), d(9999, 12, 31, 23, 59))]
    days = [d(2019, 12, 30) + timedelta(hours=12 * k) for k in range(1600)]
    _check(spark, [(i * 10 + c, c, at) for i, at in enumerate(days) for c in range(1, 7)], slots)


def test_one_class_with_very_many_long_slots(spark):
    rng = random.Random(7)
    slots = []
    for i in range(100_000):
        o = T0 + timedelta(minutes=rng.randrange(8_000_000))
        slots.append((1, o, o + timedelta(days=32 + rng.randrange(4000)) if i % 50 == 0 and o.year > 2025 else o + timedelta(minutes=rng.randrange(60))))
    turns = [(i, 1 if i % 3 == 0 else i % 40, T0 + timedelta(minutes=rng.randrange(9_000_000))) for i in range(3000)]
    _check(spark, turns, slots)
    long_ones = [(1, o, o + timedelta(days=40 + i % 900)) for i, (_, o, _) in enumerate(slots)]
    _check(spark, turns, long_ones)
    days, months, years = fe.calendar_cover(fe.schedule_slots(spark.createDataFrame(long_ones, SLOT)))
    span = (max(x for _, _, x in long_ones) - T0).days
    # rows by the calendar, not by the slots: at most one whole interval a day
    assert days.count() <= span + 1 and months.count() <= span // 28 + 1 and years.count() <= span // 365 + 1


def test_slots_meet_turns_by_calendar_piece_only(spark):
    """Plan shape: the turns are joined three times, each time by class and a date."""
    from learnscope.operators.segment import parse_time

    rows = spark.range(10).select(F.col("id").alias("turn_id"), F.greatest(F.lit(1), F.col("id") % 2).alias("session_class_id"), parse_time(F.concat(F.lit("2020-01-0"), F.lit(1) + F.col("id") % 9, F.lit(" 10:00:00"))).alias("asked_at"))
    slots = spark.createDataFrame([(1, T0, T0 + timedelta(days=400))], SLOT)
    df = fe.mark_in_class(rows, slots)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and "session_class_id" in line]
    assert len(joins) == 3 and all("__day" in line for line in joins)
    assert {r["in_slot"] for r in df.collect()} == {1}
    assert fe.mark_in_class(rows.limit(0), slots.limit(0)).collect() == []
