"""Segmentation: trap rows, fixture counts, properties (coverage, skew-bucket
invariance)."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from learnscope import fixtures as fx
from learnscope.operators import segment as sg

from .conftest import SF_MID

SCHEMA = "turn_id long, student_id long, asked_at timestamp_ntz, entry string"


def _idx(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return [r["session_index"] for r in sg.segment(df, **kw).orderBy("turn_id").collect()]


def test_gap_exactly_15_minutes_does_not_split(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [(1, 1, t0, "A"), (2, 1, t0 + timedelta(minutes=15), "A"),
            (3, 1, t0 + timedelta(minutes=30, microseconds=1), "A")]
    assert _idx(spark, rows) == [1, 1, 2]


def test_entry_changes_split(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [(1, 1, t0, "A"), (2, 1, t0 + timedelta(seconds=10), "B"), (3, 1, t0 + timedelta(seconds=20), "A")]
    assert _idx(spark, rows) == [1, 2, 3]
    assert _idx(spark, rows, split_on_entry=False) == [1, 1, 1]


def test_ties_broken_by_turn_id_and_students_independent(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [(2, 1, t0, "B"), (1, 1, t0, "A"), (3, 2, t0, "B")]
    assert _idx(spark, rows) == [1, 2, 1]


def test_fixture_session_counts(spark):
    turns = fx.load_view(spark, SF_MID, "turns")
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").selectExpr(
        "event_id AS turn_id", "user_id AS student_id", "ts AS asked_at", "event_type AS entry")

    def n(df):
        return df.select("student_id", "session_index").distinct().count()

    assert n(sg.segment(turns, 15, split_on_entry=False)) == 9774
    assert n(sg.segment(turns, 720, split_on_entry=False)) == 3292
    assert n(sg.segment(ev, 15)) == 9960
    assert n(sg.segment(ev, 720)) == 8655


def test_bucket_width_does_not_change_sessions(spark):
    turns = fx.load_view(spark, SF_MID, "turns")
    a = sg.segment(turns, 15, bucket_seconds=60).select("turn_id", "session_index")
    b = sg.segment(turns, 15, bucket_seconds=7 * 86400).select("turn_id", "session_index")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_turn_in_exactly_one_session_and_idempotent(spark):
    turns = fx.load_view(spark, SF_MID, "turns")
    s = sg.segment(turns, 15)
    assert s.count() == turns.count() == s.select("turn_id").distinct().count()
    again = sg.segment(s.drop("session_index", "is_new_session"), 15)
    assert s.select("turn_id", "session_index").exceptAll(again.select("turn_id", "session_index")).count() == 0


def test_topic_split_drops_unmapped_rows_and_keeps_unmapped_segments(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [(i, 1, t0 + timedelta(minutes=i), "A") for i in range(1, 4)] + \
           [(10 + i, 1, t0 + timedelta(hours=2, minutes=i), "A") for i in range(1, 4)]
    df = sg.with_row_in_segment(sg.segment(spark.createDataFrame(rows, SCHEMA), 15))
    mapping = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 3, 2)], "student_id long, session_index int, row_number int, topic_id int")
    out = sg.topic_split(df, mapping).orderBy("turn_id").collect()
    assert [(r["turn_id"], r["session_index"]) for r in out] == [(1, 1), (3, 2), (11, 3), (12, 3), (13, 3)]


def test_parse_mapping_variants(spark):
    replies = ['```json\n{"1": 1, "2": 1.7, "3": "2",}\n```', "[1, 1, 2]", '{"1": "1.5", "2": true}', "garbage", None]
    df = spark.createDataFrame([(r,) for r in replies], "r string").select(sg.parse_mapping("r").alias("m"))
    got = [dict(x["m"]) for x in df.collect()]
    assert got[0] == {"1": 1, "2": 1, "3": 2}
    assert got[1] == {"1": 1, "2": 1, "3": 2}
    assert got[2] == {"2": 1}
    assert got[3] == {} and got[4] == {}


def test_parse_mapping_reads_loose_json_and_survives_odd_numbers(spark):
    replies = ["{1: 1, 2: 2}", "{'1': 1, // first\n '2': 2 /* last */}", '{"1": 3000000000, "2": 1e30, "3": 3}', '{"1": 1, "a": "x // y", "2": 2,}']
    df = spark.createDataFrame([(r,) for r in replies], "r string").select(sg.parse_mapping("r").alias("m"))
    got = [dict(x["m"]) for x in df.collect()]
    assert got == [{"1": 1, "2": 2}, {"1": 1, "2": 2}, {"3": 3}, {"1": 1, "2": 2}]


def test_repeated_rows_of_a_mapping_take_the_smallest_topic(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    df = sg.with_row_in_segment(sg.segment(spark.createDataFrame([(i, 1, t0 + timedelta(minutes=i), "A") for i in range(1, 5)], SCHEMA), 15))
    mapping = spark.createDataFrame([(1, 1, r, t) for r in range(1, 5) for t in (3, 1 + r // 3)], "student_id long, session_index int, row_number int, topic_id int")
    assert [r["session_index"] for r in sg.topic_split(df, mapping).orderBy("turn_id").collect()] == [1, 1, 2, 2]


def test_segmenter_hook_runs_in_pandas(spark):
    turns = fx.load_view(spark, SF_MID, "turns")
    rows = sg.with_row_in_segment(sg.segment(turns, 720, split_on_entry=False))
    pay = sg.segment_payloads(rows)

    def stub(items):  # deterministic stand-in for a topic segmenter
        return {str(it["row_number"]): 1 + (it["row_number"] - 1) // 4 for it in items}

    m = sg.apply_segmenter(pay, stub)
    out = sg.topic_split(rows, m)
    assert out.count() == rows.count()  # full mappings keep every turn
    assert out.agg(F.max("session_index")).first()[0] >= rows.agg(F.max("session_index")).first()[0]


def test_session_class_is_first_turns_class_across_buckets(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").selectExpr(
        "event_id AS turn_id", "user_id AS student_id", "ts AS asked_at", "event_type AS entry", "event_id % 3 AS class_id")
    s = sg.segment(ev, 720, split_on_entry=False, bucket_seconds=60)
    first = s.groupBy("student_id", "session_index").agg(F.min_by("class_id", F.struct("asked_at", "turn_id")).alias("want"))
    bad = s.join(first, ["student_id", "session_index"]).filter(~F.col("session_class_id").eqNullSafe(F.col("want")))
    assert bad.count() == 0


def test_json5_reader():
    from learnscope.functions.replies import read_json5, read_reply

    assert read_json5("{a: 1, 'b\\'c': [1, .5, 5., +7, -0x1F, 1e3,], \"d\": {/* x */}, $e_1: null, // end\n 7: true,}") == {
        "a": 1, "b'c": [1, 0.5, 5.0, 7, -31, 1000.0], "d": {}, "$e_1": None, "7": True}
    assert read_json5("'\\x41\\u00e9\\\n\\v\\q'") == "A\u00e9\vq" and read_json5(" [ ] ") == [] and read_json5("-Infinity") == float("-inf")
    assert read_json5('"// no comment" // one') == "// no comment"
    for bad in ["", "{", "[1 2]", "{a 1}", "{a:}", "[,]", "{,}", "{a: 1}}", "[1]]", "1 2", "{1}", "[1}", "word", "'open", "{a: 1, : 2}", "/* open", "0x", "1a", "]"]:
        try:
            read_json5(bad)
        except (KeyError, ValueError):
            continue
        raise AssertionError(bad)
    deep = "[" * 50_000 + "]" * 50_000
    assert read_reply(deep) == {} and read_reply("{a: " * 50_000) == {}
    assert read_reply('{"1": 1, "2": Infinity}') == {} and read_reply("{1: 1, 2: 1e999}") == {}
    assert read_reply('{"1": NaN, "2": null, "3": [1], "4": " 5 ", "5": 2.9, "6": -3000000000, "1": 4, "7": "x"}') == {"1": 4, "4": 5, "5": 2}
    assert read_reply("```\n{1: 1, 2: 1}\n```") == {"1": 1, "2": 1} and read_reply(None) == {} and read_reply("7") == {}


def test_json5_reader_agrees_with_json():
    import json
    import random

    from learnscope.functions.replies import read_json5

    rng = random.Random(0)

    def value(depth):
        kind = rng.randrange(8 if depth else 6)
        if kind < 6:
            return [None, True, rng.randrange(-99, 99), rng.random() * 10 ** rng.randrange(-9, 9), "".join(rng.choice("ab'\"\\/\n\t é☃,:{}[]") for _ in range(6)), ""][kind]
        items = [value(depth - 1) for _ in range(rng.randrange(4))]
        return items if kind == 6 else {str(value(0)): x for x in items}

    for _ in range(500):
        v = value(4)
        text = json.dumps(v, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        assert read_json5(text) == v


def test_column_and_hook_read_replies_alike(spark):
    replies = ["```json\n{1: 1, 2: 1, 3: 2,}\n```", "{'1': 1, '2': 0x2, 3000000000: 7, '3': 3000000000}", '{"1": 1, "3": Infinity}', "[1, null, 2]", "broken {", '{"1": 1e999}', "{a: 5, 2: '2'}"]
    items = '[{"row_number": 1}]'
    pay = spark.createDataFrame([(i, 1, items, r) for i, r in enumerate(replies)], "student_id long, session_index int, payload string, reply string")
    by_column = {tuple(r) for r in sg.mapping_rows(pay.withColumn("mapping", sg.parse_mapping("reply"))).collect()}
    answers = iter(replies)
    hooked = sg.apply_segmenter(pay.coalesce(1).sortWithinPartitions("student_id"), lambda rows: next(answers))
    assert {tuple(r) for r in hooked.collect()} == by_column
    assert by_column == {(0, 1, 1, 1), (0, 1, 2, 1), (0, 1, 3, 2), (1, 1, 1, 1), (1, 1, 2, 2), (3, 1, 1, 1), (3, 1, 3, 2), (6, 1, 2, 2)}


def test_too_long_segments_are_rejected_and_the_others_go_on(spark):
    t0 = datetime(2024, 1, 1, 9, 0)
    rows = [(i, 1, t0 + timedelta(minutes=i), "A") for i in range(9)] + [(100 + i, 2, t0 + timedelta(minutes=i), "A") for i in range(4)]
    df = sg.with_row_in_segment(sg.segment(spark.createDataFrame(rows, SCHEMA).withColumns({"question_text": F.lit("q"), "ai_response": F.lit("a")}), 15))
    pay = sg.segment_payloads(df, max_rows=5)
    assert [(r["student_id"], r["n_rows"]) for r in pay.collect()] == [(2, 4)]
    assert [tuple(r) for r in sg.rejected_segments(df, max_rows=5).collect()] == [(1, 1, 9, "too_long")]
    out = sg.topic_split(df, sg.apply_segmenter(pay, lambda turns: {t["row_number"]: t["row_number"] for t in turns}))
    assert out.groupBy("student_id").agg(F.count_distinct("session_index").alias("n")).orderBy("student_id").collect() == [(1, 1), (2, 4)]


def test_a_very_long_segment_gets_its_whole_payload(spark):
    n = 100_003
    rows = spark.range(n).select(F.lit(1).cast("long").alias("student_id"), F.lit(1).alias("session_index"), (F.lit(n) - F.col("id")).cast("int").alias("row_number"),
                                 F.lit(n).cast("long").alias("segment_rows"), F.lit(datetime(2024, 1, 1, 9)).cast("timestamp_ntz").alias("asked_at"),
                                 F.concat(F.lit('say "'), F.col("id").cast("string"), F.lit('"')).alias("question_text"), F.lit(None).cast("string").alias("ai_response"))
    (pay,) = sg.segment_payloads(rows.repartition(4)).collect()
    turns = json.loads(pay["payload"])
    assert pay["n_rows"] == n and [t["row_number"] for t in turns] == list(range(1, n + 1))
    assert turns[n - 1] == {"row_number": n, "timestamp": "2024-01-01 09:00:00", "question": 'say "0"', "ai_response": ""}
    assert sg.rejected_segments(rows).count() == 0
