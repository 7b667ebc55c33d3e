"""Text scalars and per-session text signals on hand-made rows (values counted
independently, see FIXTURES.md §5)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from learnscope.functions import lexicon as L
from learnscope.functions import text as X
from learnscope.operators import features as fe

# question, image, cleaned length, copy patterns, copy phrases, answer phrases, understanding phrases, hypothetical regexes
HAND_ROWS = [
    ("这道题怎么做？答案是什么", 0, 12, 0, 3, 2, 0, 0),
    ("如果温度升高会怎样", 0, 9, 0, 0, 0, 2, 1),
    ("1、A ____ (5分)", 0, 13, 3, 0, 0, 0, 0),
    ("Ａ．　Ｂ．", 0, 5, 0, 2, 0, 0, 0),
    ("可以解释一下吗", 0, 7, 0, 0, 0, 0, 1),
    ("A.甲 B.乙", 0, 7, 1, 2, 0, 0, 0),
    ("那如果会怎样", 0, 6, 0, 0, 0, 3, 2),
    ("答 案", 0, 3, 0, 1, 1, 0, 0),
    ("请上传你的文件（Please upload the file）", 0, 0, 0, 1, 0, 0, 0),
    ('<img src="a.png"> 选什么', 1, 3, 0, 2, 1, 0, 0),
]


@pytest.fixture(scope="module")
def hand(spark):
    return spark.createDataFrame([(i, r[0]) for i, r in enumerate(HAND_ROWS)], "i int, q string")


def test_scalars_match_hand_counts(hand):
    s = hand.select(
        "i",
        X.has_image("q").cast("int").alias("img"),
        X.question_length("q").alias("len"),
        X.patterns_count("q", L.NON_NATURAL_PATTERNS).alias("pat"),
        X.phrases_count(X.normalize("q"), L.COPY_KEYWORDS).alias("copy"),
        X.phrases_count(X.normalize("q"), L.ANSWER_SEEKING_KEYWORDS_PROMPT).alias("ans"),
        X.phrases_count(X.normalize("q"), L.UNDERSTANDING_KEYWORDS_PROMPT).alias("und"),
        X.patterns_count("q", L.HYPOTHETICAL_PATTERNS).alias("hyp"),
    ).orderBy("i").collect()
    for row, exp in zip(s, HAND_ROWS):
        assert tuple(row)[1:] == exp[1:], (exp[0], tuple(row))


def test_regex_dialect_traps(spark):
    df = spark.createDataFrame([("如果\r你会",), ("１２３",), ("a b\x1cc",), ("Notice: x\nkeep ",), ("<IMG src>x",)], "s string")
    r = df.select(
        X.pattern_count("s", "如果[^\\n]*会").alias("hyp"),
        X.normalize("s").alias("norm"),
        X.question_length("s").alias("len"),
    ).collect()
    assert r[0]["hyp"] == 1          # Python's dot crosses \r
    assert r[1]["norm"] == "123"     # full width -> half width
    assert r[2]["norm"] == "abc"     # Unicode spaces and \x1c are whitespace
    assert r[3]["len"] == len("keep")  # Notice rule stops at the newline
    assert r[4]["len"] == 1          # <img ...> removed case-insensitively


def test_phrase_count_is_non_overlapping(spark):
    r = spark.range(1).select(X.phrase_count(F.lit("答案答案是什么"), "答案").alias("a"),
                              X.phrase_count(F.lit("aaa"), "aa").alias("b")).first()
    assert (r["a"], r["b"]) == (2, 1)


def _session(spark, rows):
    t = spark.createDataFrame(
        [(i, 1, 0, datetime(2024, 1, 1, 9, i), e, q, a) for i, (e, q, a) in enumerate(rows)],
        "turn_id long, student_id long, class_id long, asked_at timestamp_ntz, entry string, question_text string, ai_response string",
    ).withColumn("session_index", F.lit(1))
    return fe.text_signals(fe.behavioral(fe.session_summary(t))).first()


def test_first_reply_and_image_bonus(spark):
    r = _session(spark, [("自由提问", "![x](y)", "这道题的正确答案是选项B")])
    assert r["answer_seeking_intensity"] == 4 + 1  # reply phrases + image bonus
    assert r["copy_paste_score"] == 1
    r2 = _session(spark, [("课堂不懂", "![x](y)", "")])
    assert r2["answer_seeking_intensity"] == 0 and r2["copy_paste_score"] == 0


def test_phrases_pool_across_turns(spark):
    # whitespace removal lets a phrase straddle two turns (pooled before counting)
    r = _session(spark, [("自由提问", "这道", ""), ("自由提问", "题", "")])
    assert r["copy_paste_score"] == 1


def test_java_whitespace_class_equals_python_whitespace(spark):
    cps = [c for c in range(0x110000) if not (0xD800 <= c <= 0xDFFF)]
    df = spark.createDataFrame([(c, chr(c)) for c in cps], "c int, s string")
    java = {r["c"] for r in df.filter(F.col("s").rlike("^" + L.WS_JAVA + "$")).collect()}
    assert java == {c for c in cps if chr(c).isspace()}


def test_lexicon_override_reaches_features(spark):
    t = spark.createDataFrame([(1, 1, 0, datetime(2024, 1, 1, 9), "自由提问", "banana split", "")],
                              "turn_id long, student_id long, class_id long, asked_at timestamp_ntz, entry string, question_text string, ai_response string") \
        .withColumn("session_index", F.lit(1))
    s = fe.behavioral(fe.session_summary(t))
    assert fe.text_signals(s).first()["copy_paste_score"] == 0
    assert fe.text_signals(s, lexicon={"copy": ["banana"]}).first()["copy_paste_score"] == 1
