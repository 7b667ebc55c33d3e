"""Text signals of sessions whose texts are not joined in one row: one session
holds a third of all turns; counts must equal those over its whole text."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from learnscope.functions import lexicon as L
from learnscope.functions import text as X
from learnscope.operators import features as fe

WORDS = [
    "这道题", "怎么做", "答案", "答案是什么", "如果", "会", "那如果", "可以", "吗", "是不是不是", "是不是", "不是", "我觉得", "温度升高", "化学反应速率的影响因素",
    "A.", "B、", "C) ", "甲", "12.", "3、", "选", "（ 5", "分 ", ")", "(", "```", "____", "[", "]", "please", "upload", "the file", "Ａ．", "　", " ", "", "x" * 60, "的", "了", "实验", "看看",
]
SCHEMA = "turn_id long, student_id long, class_id long, asked_at timestamp_ntz, entry string, question_text string, ai_response string, session_index int, turn_rank long"


def _whole(texts):
    """(copy, answer, understanding) phrases and patterns over the joined text."""
    raw = " ".join(texts)
    norm = "".join(c for c in raw.translate(str.maketrans(L.FULLWIDTH_FROM, L.FULLWIDTH_TO)) if not c.isspace())

    def n(pattern):
        return len(re.findall(pattern.replace(L.DIGIT, r"\d").replace(L.WS, r"\s"), raw))

    copy = sum(map(norm.count, L.COPY_KEYWORDS)) + sum(map(n, L.NON_NATURAL_PATTERNS))
    return copy, sum(map(norm.count, L.ANSWER_SEEKING_KEYWORDS_PROMPT)), sum(map(norm.count, L.UNDERSTANDING_KEYWORDS_PROMPT)) + sum(map(n, L.HYPOTHETICAL_PATTERNS))


def _turn(rng, newlines):
    words = [rng.choice(WORDS) for _ in range(rng.randrange(0, 9))]
    if rng.random() < 0.3:  # long enough for an edge to end
        words.insert(rng.randrange(len(words) + 1), "".join(rng.choice("物理化学生数语文史地政") for _ in range(80)))
    return rng.choice(["", " ", "\n"] if newlines else ["", " "]).join(words)


def _turns(spark, sessions):
    t0, rows, at = datetime(2024, 3, 1), [], 0
    for s, texts in sessions.items():
        for rank, q in enumerate(texts):
            rows.append((at, s, 0, t0 + timedelta(seconds=rank // 3), "自由提问", q, "答案", 1, rank + 1))
            at += 1
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("newlines", [False, True])
def test_long_sessions_equal_their_whole_text(spark, newlines, monkeypatch):
    monkeypatch.setattr(fe, "PIECE_TURNS", 40)
    monkeypatch.setattr(fe, "LONG_TURNS", 10)
    rng = random.Random(11 + newlines)
    sessions = {0: [_turn(rng, newlines) for _ in range(1500)]}  # a third of all turns
    sessions |= {s: [_turn(rng, newlines) for _ in range(rng.choice([1, 3, 60, 200]))] for s in range(1, 48)}
    sessions[100] = [""] * 300
    sessions[101] = ["A.甲 B.乙 "] * 300  # labels all along: pieces stay whole
    sessions[102] = ["答", "案"] * 150
    sessions[103] = ["是不", ""] * 150 + ["是" + "物理" * 60, "不是"] * 20
    pieces = fe.session_signals(_turns(spark, sessions))
    assert pieces.filter("student_id = 0").select(F.length("pooled_prompts")).first()[0] < sum(map(len, sessions[0])) / 2
    out = fe.text_signals(fe.behavioral(pieces)).collect()
    got = {r["student_id"]: tuple(map(int, (r["copy_paste_score"], r["answer_seeking_intensity"], r["understanding_signal_strength"]))) for r in out}
    for s, texts in sessions.items():
        copy, answer, understanding = _whole(texts)
        long = int(sum(map(len, texts)) / len(texts) > L.LONG_QUESTION_CHARS)
        assert got[s] == (copy + long, answer + 1, understanding), s  # the reply holds one answer phrase


def test_pieces_equal_the_session_in_one_row(spark):
    rng = random.Random(5)
    t = _turns(spark, {s: [_turn(rng, False) for _ in range(rng.choice([1, 5, 300]))] for s in range(12)})
    one, parts = fe.behavioral(fe.session_summary(t)), fe.behavioral(fe.session_signals(t))
    same = [c for c in one.columns if c != "pooled_prompts"]
    assert sorted(map(tuple, one.select(same).collect())) == sorted(map(tuple, parts.select(same).collect()))
    a = {r["student_id"]: r["copy_paste_score"] for r in fe.text_signals(one).collect()}
    assert a == {r["student_id"]: r["copy_paste_score"] for r in fe.text_signals(parts).collect()}


def test_own_patterns_see_the_whole_text(spark):
    t = _turns(spark, {0: ["a" * 80 + " begin"] + ["物理" * 40] * 600 + ["end " + "a" * 80]})
    own = {"hypothetical": ["begin[^\\n]*end"], "copy": ["物理物"]}
    r = fe.text_signals(fe.behavioral(fe.session_signals(t, own)), lexicon=own).first()
    assert (r["understanding_signal_strength"], r["copy_paste_score"]) == (1, ("物理" * 24000).count("物理物"))


def test_default_phrases_fit_an_edge():
    assert max(map(len, L.COPY_KEYWORDS + L.ANSWER_SEEKING_KEYWORDS_PROMPT + L.UNDERSTANDING_KEYWORDS_PROMPT)) <= X.EDGE_CHARS
