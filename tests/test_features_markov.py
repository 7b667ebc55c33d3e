"""Calendar features, reject cascade, imputation, Markov transitions."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from learnscope.operators import features as fe
from learnscope.operators import markov as mk
from learnscope.plans import common as C

from .conftest import SF_MID


def _temporal(spark, start, end, t):
    df = spark.createDataFrame([(start, end, t)], "course_start timestamp_ntz, course_end timestamp_ntz, t_min timestamp_ntz")
    return fe.temporal(df).first()


def test_day_period_boundaries(spark):
    s, e = datetime(2024, 1, 1), datetime(2024, 3, 1)
    assert _temporal(spark, s, e, datetime(2024, 1, 5, 7, 59))["day_period"] == 24
    assert _temporal(spark, s, e, datetime(2024, 1, 5, 8, 0))["day_period"] == 1


def test_course_progress_uses_python_floor_division(spark):
    # window 22 days, day 11: Python 11 // 1.1 == 9.0 -> week 10 (naive floor gives 11)
    assert _temporal(spark, datetime(2024, 1, 1), datetime(2024, 1, 23), datetime(2024, 1, 12))["course_progress_ratio"] == 10
    # window 140 days, day 140 -> 21, clamped to 20
    assert _temporal(spark, datetime(2024, 1, 1), datetime(2024, 5, 20), datetime(2024, 5, 20))["course_progress_ratio"] == 20


def test_exam_week(spark):
    s, e = datetime(2024, 1, 1), datetime(2024, 3, 1)
    assert _temporal(spark, s, e, datetime(2024, 2, 2))["is_exam_week"] == 1
    assert _temporal(spark, s, e, datetime(2024, 2, 1))["is_exam_week"] == 0


def test_reject_reason_table(spark):
    ext = C.extracted(spark, SF_MID)
    got = {r["reject_reason"]: (r["n"], r["one"], r["two"], r["more"]) for r in ext.groupBy("reject_reason").agg(
        F.count("*").alias("n"), F.count_if(F.col("qa_turns") == 1).alias("one"),
        F.count_if(F.col("qa_turns") == 2).alias("two"), F.count_if(F.col("qa_turns") > 2).alias("more")).collect()}
    from learnscope.plans import registry

    from .oracle_check import duck

    registry.load_all()
    sql = f"""SELECT reject_reason, count(*), count(*) FILTER (WHERE qa_turns = 1), count(*) FILTER (WHERE qa_turns = 2),
      count(*) FILTER (WHERE qa_turns > 2) FROM ({registry.ORACLES["flt_reject_reason"]}) GROUP BY 1"""
    assert got == {r[0]: r[1:] for r in duck(SF_MID).execute(sql).fetchall()}
    assert set(got) == {"ok", "no_class", "bad_window", "out_of_range"}


def test_single_turn_imputation_fallbacks(spark):
    rows = [("a", 0, 1, 0.0), ("b", 0, 2, 6.0), ("c", 1, 1, 0.0), ("d", 1, 3, 9.0), ("e", 2, 2, 12.0)]
    df = spark.createDataFrame(rows, "file_name string, class_id long, qa_turns int, avg_qa_time_minutes double")
    got = {r["file_name"]: r["avg_qa_time_minutes"] for r in fe.impute_single_turn(df).collect()}
    assert got["a"] == 2.0            # own class 2-turn median / 3
    assert got["c"] == 9.0 / 3        # class has no 2-turn sessions: global 2-turn median (6, 12 -> 9) / 3
    assert got["b"] == 6.0 and got["d"] == 9.0


def test_markov_skips_unknown_states_without_bridging(spark):
    rows = [(1, 0, 1, datetime(2024, 1, 1, 9), 0), (1, 0, 2, datetime(2024, 1, 1, 10), 4), (1, 0, 3, datetime(2024, 1, 1, 11), 1)]
    df = spark.createDataFrame(rows, "student_id long, class_id long, event_id long, dialog_time timestamp_ntz, cluster int")
    counts = {(r["from_state"], r["to_state"]): r["n"] for r in mk.transition_counts(mk.transitions(df)).collect() if r["n"]}
    assert counts == {("START", "c0"): 1, ("c1", "END"): 1}


def test_markov_probability_rows_and_totals(spark):
    cl = C.clustered(spark, SF_MID)
    tr = mk.transitions(cl)
    counts = mk.transition_counts(tr)
    steps = tr.filter((F.col("from_state") != "START") & (F.col("to_state") != "END"))
    known = F.col("from_state").isin("c0", "c1", "c2", "c3") & F.col("to_state").isin("c0", "c1", "c2", "c3")
    assert steps.filter(known).count() == 6349      # cluster -> cluster steps between known states
    assert steps.filter(~known).count() == 3501     # steps touching c4 (skipped, not bridged)
    assert tr.count() == cl.count() + 150  # one transition per row plus one START per sequence
    probs = mk.transition_probs(counts)
    for r in probs.groupBy("from_state").agg(F.sum("p").alias("s")).collect():
        assert abs(r["s"] - (0.0 if r["from_state"] == "END" else 1.0)) < 1e-9


def test_annotation_uses_python_rounding(spark):
    df = spark.createDataFrame([(0.125, 1), (0.135, 2)], "p double, n long")
    got = [r["annotation"] for r in mk.annotate(df).collect()]
    assert got == ["0.12\n(1)", "0.14\n(2)"]


def test_sessions_never_cross_source_files(spark):
    from learnscope.operators import segment as sg

    t0 = datetime(2024, 1, 1, 9)
    rows = [("a.csv", 1, 1, t0, "A"), ("b.csv", 2, 1, t0.replace(minute=1), "A"), ("a.csv", 3, 1, t0.replace(minute=2), "A")]
    df = spark.createDataFrame(rows, "source string, turn_id long, student_id long, asked_at timestamp_ntz, entry string")
    got = {r["turn_id"]: (r["source"], r["session_index"]) for r in sg.segment(df, 15).collect()}
    assert got == {1: ("a.csv", 1), 3: ("a.csv", 1), 2: ("b.csv", 1)}


def test_rare_reject_reasons(spark):
    summ = spark.createDataFrame(
        [(1, 1, 1, datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 9), 0),   # bad time
         (2, 1, 2, datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 9, 30), 0),  # same-day window, end > start
         (3, 1, 3, datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 9), 0),   # not in allowlist
         (4, 1, 1, datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 9), 0)],  # ok
        "student_id long, session_index int, class_id long, t_min timestamp_ntz, t_max timestamp_ntz, any_bad_time int",
    ).withColumn("any_bad_time", F.when(F.col("student_id") == 1, 1).otherwise(0))
    windows = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), datetime(2024, 3, 1)), (2, datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 18)),
         (3, datetime(2024, 1, 1), datetime(2024, 3, 1))],
        "class_id long, course_start timestamp_ntz, course_end timestamp_ntz")
    allow = spark.createDataFrame([(1,), (2,)], "class_id long")
    got = {r["student_id"]: r["reject_reason"] for r in fe.reject_reason(summ, windows, allow).collect()}
    assert got == {1: "invalid_time", 2: "zero_day_window", 3: "filtered_by_class_info", 4: "ok"}
    none = {r["student_id"]: r["reject_reason"] for r in fe.reject_reason(summ, windows, allow.filter("false")).collect()}
    assert none[3] == "ok"  # an empty allowlist filters nothing


def test_slots_of_any_length(spark):
    t0 = datetime(2024, 1, 5, 9)
    turns = spark.createDataFrame([(i, 1, c, t0 + timedelta(days=d)) for i, (c, d) in enumerate([(1, 0), (1, 40), (2, 0), (2, 3000), (3, 0)])],
                                  "turn_id long, student_id long, session_class_id long, asked_at timestamp_ntz")
    slots = spark.createDataFrame([(1, datetime(2024, 1, 5, 8), datetime(2024, 1, 5, 10)), (1, datetime(2024, 1, 5, 9), datetime(2024, 1, 6)),
                                   (2, datetime(2024, 1, 5), datetime(9999, 12, 31)), (2, datetime(2024, 1, 1), datetime(2024, 6, 1)), (3, None, datetime(2024, 6, 1))],
                                  "class_id long, open_at timestamp_ntz, close_at timestamp_ntz")
    got = {r["turn_id"]: r["in_slot"] for r in fe.mark_in_class(turns, slots).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 1, 4: 0}
