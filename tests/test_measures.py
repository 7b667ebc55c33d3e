"""Measures taken per turn, before the segmentation: equal to the Column forms, and
no whole text behind them."""

import random
import re
import time
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import functions as F

from learnscope import fixtures as fx
from learnscope.functions import lexicon as L
from learnscope.functions import measures as M
from learnscope.functions import text as X
from learnscope.operators import features as fe
from learnscope.operators import segment as sg
from learnscope.sources import io

BITS = [*"ABCD.、)选项会吗如果可以那分 \n\t　１Ａ．_[]`!<>(（）:：①٣ſK", "如果", "可以", "是不是", "答案", "Notice:", "<IMG src", "![a](b)", "请上传你的文件（Please Upload the file）", "plain words ", "x" * 60, "1、A", "( 5 分 )"]


def _texts(n, most):
    rng = random.Random(3)
    return [None, ""] + ["".join(rng.choice(BITS) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_measures_equal_their_column_forms(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(400, 60))], "i int, s string")
    lists = [L.COPY_KEYWORDS, L.UNDERSTANDING_KEYWORDS_PROMPT]
    count = M.phrase_counter(lists)
    n = X.normalize("s")
    rows = df.select(
        "s", n.alias("norm"), X.question_length("s").alias("clen"), X.has_image("s").alias("image"), X.phrases_count(n, lists[0]).alias("a"), X.phrases_count(n, lists[1]).alias("b"),
        X.patterns_count("s", L.NON_NATURAL_PATTERNS).alias("copy"), X.patterns_count("s", L.HYPOTHETICAL_PATTERNS).alias("hyp")).collect()
    for r in rows:
        s = r["s"]
        got = (M.normalized(s), M.cleaned_length(s), M.has_image(s), *count(M.normalized(s)), M.patterns_found(s or "", M.COPY_PATTERNS), M.patterns_found(s or "", M.HYPOTHETICAL))
        assert got == tuple(r)[1:], s


def test_edges_add_up():
    lists = fe._lists(None)
    run = M.signal_edges(lists)
    count = M.phrase_counter([lists["copy"], lists["answer_prompt"], lists["understanding"]])

    def counts(s):
        c, a, u = count(M.normalized(s))
        return c + M.patterns_found(s, M.COPY_PATTERNS), a, u + M.patterns_found(s, M.HYPOTHETICAL)

    texts, short = [t or "" for t in _texts(600, 300)], 0
    for i in range(0, len(texts), 5):
        group = texts[i:i + 5]
        cut = [run(t) for t in group]
        short += sum(len(e[0]) < len(t) for e, t in zip(cut, group))
        joined = counts(" ".join(e[0] for e in cut))
        assert counts(" ".join(group)) == tuple(j + sum(e[k + 1] for e in cut) for k, j in enumerate(joined))
    assert short > 200


OWN = {
    "copy": ["the", "答案", "aa"], "copy_patterns": [r"[0-9]{4,}", r"[#*$%&]{3}", r"(?:ab|c\.)+"], "answer_prompt": ["and", "and", "A1"],
    "answer_reply": ["of"], "understanding": ["why", "为什么"], "hypothetical": [r"if[^\n]*then", r"[.] "],
}


def test_edges_of_own_patterns(spark):
    """A caller's own patterns: the turns are cut, the session's counts are those of its whole text."""
    assert all(M.stops(p) is None for p in (r"\d+", r"a.b", r"^a", r"a\b", r"(?i)a", r"(?=a)b", r"a*", r"[^\s\S]?", r"(a)\1", r"[a&&b]", r"\p{L}", ""))
    assert M.signal_edges(fe._lists({**OWN, "hypothetical": [r"a.b"]})) is None
    rng, bits = random.Random(5), [*"01239#*$% .\n\nabcA１Ａ", "if", "then", "the ", "a n d", "why", "为什么", "答 案", "ab", "c.", "aaa"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.choice((10, 400, 900)))) for _ in range(120)]
    texts[:2] = ["9" * 700, "if " * 300 + "then"]
    lx = fe._lists(OWN)
    t0 = datetime(2024, 3, 1)
    rows = [(i, i // 4, 0, t0 + timedelta(minutes=i), "自由提问", x, "of " * 60) for i, x in enumerate(texts)]
    t = spark.createDataFrame(rows, "turn_id long, student_id long, class_id long, asked_at timestamp_ntz, entry string, question_text string, ai_response string")
    m = sg.segment(fe.measure_turns(t, lexicon=OWN), gap_minutes=720, split_on_entry=True)
    assert m.agg(F.sum(F.length("question_text"))).first()[0] < 0.6 * sum(map(len, texts))
    got = fe.text_signals(fe.behavioral(fe.session_signals(m, OWN)), lexicon=OWN)
    for r in got.collect():
        s = " ".join(texts[4 * r["student_id"]:4 * r["student_id"] + 4])
        n = M.normalized(s)

        def found(phrases, patterns=()):
            return sum(n.count(p) for p in lx[phrases]) + sum(len(re.findall(p, s)) for p in patterns)

        long = sum(map(len, texts[4 * r["student_id"]:4 * r["student_id"] + 4])) / 4 > L.LONG_QUESTION_CHARS
        assert r["copy_paste_score"] == found("copy", lx["copy_patterns"]) + long
        assert r["understanding_signal_strength"] == found("understanding", lx["hypothetical"])
        assert r["answer_seeking_intensity"] == found("answer_prompt") + M.normalized(("of " * 60)[:100]).count("of")


def test_no_whole_text_behind_the_measures(spark):
    t0 = datetime(2024, 3, 1)
    rows = [(i, i % 3, 0, t0 + timedelta(minutes=i), "自由提问", "long words " * 500, "reply " * 500) for i in range(30)]
    t = spark.createDataFrame(rows, "turn_id long, student_id long, class_id long, asked_at timestamp_ntz, entry string, question_text string, ai_response string")
    seg = sg.segment(fe.measure_turns(t), gap_minutes=720, split_on_entry=True)
    r = seg.agg(F.max(F.length("question_text")), F.max(F.length("__reply")), F.max("__clen")).first()
    assert r[0] < 300 and r[1] == L.FIRST_REPLY_CHARS and r[2] == 5499
    assert "ai_response" not in seg.columns and "question_text" not in fe.measure_turns(t, "none").columns
    assert sg.payload_texts(t).agg(F.max(F.length("ai_response"))).first()[0] == L.PAYLOAD_TEXT_CHARS


def test_compressed_logs_are_read_where_they_are(spark, tmp_path):
    rows = [(i, 1, f"2024-03-01 10:{i % 60:02d}:00", 'a "quoted"\n, line ' * 40) for i in range(500)]
    t = spark.createDataFrame(rows, "turn_id long, student_id long, asked_at string, question_text string").repartition(3)
    io.write_csv(t, str(tmp_path / "log"), headers=io.TURN_HEADERS, compression="gzip")
    assert sum(f.stat().st_size for f in (tmp_path / "log").glob("*.gz")) < 100_000 and not list((tmp_path / "log").glob("*.csv"))
    r = io.read_turns_csv(spark, str(tmp_path / "log"))
    got = {(x["turn_id"], x["question_text"]) for x in r.collect()}
    assert got == {(i, q.replace("\n", " ")) for i, _, _, q in rows}
    r.collect()
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Sort \[[^\]]*\bid#", plan) and not re.search(r"Sort \[[^\]]*position#", plan)  # no line, no row


def test_batch_of_normalized_texts():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [*every, "".join(every), *_texts(400, 60), None, ""]
    batch = pa.array(texts, pa.string())
    want = [M.normalized(t) for t in texts]
    assert M.normalized_texts(batch).to_pylist() == want
    assert M.normalized_texts(batch.slice(60, 9000)).to_pylist() == want[60:9060]
    assert M.normalized_texts(batch.slice(0, 0)).to_pylist() == []


def test_full_width_texts_are_normalized_at_the_speed_of_others():
    """A few full-width characters do not cost a look-up for each character of the text."""
    def seconds(t):
        at = time.perf_counter()
        for _ in range(20):
            M.normalized(t)
        return time.perf_counter() - at

    text = "条件 " * 20_000
    assert min(seconds(text + "？") for _ in range(3)) < 4 * min(seconds(text) for _ in range(3))


def test_numbered_options_are_counted_by_their_ends():
    p = re.compile(M.python_pattern(L.NON_NATURAL_PATTERNS[0]))
    rng = random.Random(5)
    for _ in range(3000):
        s = "".join(rng.choice("1٣.、 \nA选xE") for _ in range(rng.randrange(14)))
        assert M.patterns_found(s, M.COPY_PATTERNS[:1]) == sum(1 for _ in p.finditer(s)), s


def test_turns_are_measured_in_many_tasks(spark, tmp_path):
    at = datetime(2024, 1, 1)
    events = [(i, i % 7, at + timedelta(minutes=i), "click") for i in range(500)] + [(3, 3, at, "view"), (None, None, None, None)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, event_type string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, "text") for i in range(10)] + [(1, "twice")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    t = fx.load_view(spark, str(tmp_path), "turns").select("turn_id", F.spark_partition_id().alias("p")).collect()
    n = 11
    assert len({r["p"] for r in t}) > 1
    assert len(t) == len(events) + sum(e[0] is not None and e[0] % n == 1 for e in events)
