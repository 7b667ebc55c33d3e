"""Target-distribution importance resampling against a plain computation."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from learnscope.llm import importance


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(rows, target, percent, least):
    def buckets(t):
        return [zlib.crc32(f.encode()) % 10000 for f in features(t)[1]]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(((t[b] + 1) * (big_s + 10000)) / ((s[b] + 1) * (big_t + 10000))))

    out = []
    for key, text in rows:
        bs = buckets(text)
        weight = sum(map(gain, bs)) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(bs), weight, score, len(features(text)[0]) >= least])
    pool = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = pool[: percent * len(pool) // 100]
    return sorted(([*r[:4], i + 1] for i, r in enumerate(drawn)), key=str), len(out)


def run(docs, target, percent=25, least=20):
    scored = importance.score(docs, target)
    words, feats, weight, by = scored.columns[len(docs.columns):]
    out = importance.ranked(scored, percent, F.col(words) >= least, by, features=feats)
    return out.select("doc_id", feats, weight, by, out.columns[-1]).collect()


TARGET = ["the quick brown fox jumps over the lazy dog " * 4, "Ünïcode wörds and the fox", None, ""]


def test_matches_plain_computation(spark, make, odd):
    rng = np.random.default_rng(3)
    vocabulary = ["the", "Fox", "dog,", "lazy-river", "wörds", "x1", "QUICK", "日本", "a" * 90]
    rows = [*odd, *((100 + i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(300))]
    rows = [(r[0], r[1]) for r in rows]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    for clash in (False, True):
        docs = make(rows, clash=clash).withColumn("rank", F.lit("mine")) if clash else make(rows)
        for percent in (25, 100, 0):
            got = run(docs, target, percent)
            want, n = brute(rows, TARGET, percent, 20)
            assert len(got) == n
            assert sorted((list(r) for r in got if r[4] is not None), key=str) == want


def test_long_words_and_lone_parts():
    text = ["x" * 1000 + " B", "", "B", "é" * 64 + "_q"]
    raw = [t.encode() for t in text]
    off = np.cumsum([0, *map(len, raw)])
    words, found, of = importance.feature_buckets(np.frombuffer(b"".join(raw), np.uint8), off, 10000)
    want = sorted((i, zlib.crc32(f.encode()) % 10000) for i, t in enumerate(text) for f in features(t)[1])
    assert sorted(zip(of.tolist(), found.tolist())) == want and words.tolist() == [2, 0, 1, 2]


def test_cut_among_ties_and_repeated_rows(spark):
    """One score for all: keys decide; a third of the rows are one repeated row."""
    rows = [(i, 5, 40, 30) for i in range(40)] + [(7, 5, 40, 30)] * 30 + [(None, 5, 40, 30)] * 20 + [(3, 9, 40, 5)] * 9
    df = spark.createDataFrame(rows, "doc_id long, score long, n_features long, n_words long").repartition(5)
    for percent in (1, 10, 33, 60, 95, 100):
        out = importance.ranked(df, percent, F.col("n_words") >= 20).collect()
        drawn = sorted((r["rank"], r["doc_id"]) for r in out if r["rank"] is not None)
        pool = sorted((r for r in rows if r[3] >= 20), key=lambda r: (r[0] is None, r[0] or 0))
        assert len(out) == len(rows)
        assert drawn == [(i + 1, r[0]) for i, r in enumerate(pool[: percent * len(pool) // 100])]


def test_drawn_documents_keep_their_columns(spark, make, odd):
    rows = [(r[0], r[1]) for r in odd] + [(50 + i, "the quick brown fox " * 6) for i in range(20)]
    docs = make(rows, clash=True)
    out = importance.draw(docs, spark.createDataFrame([(t,) for t in TARGET], "text string"), percent=50)
    assert out.columns[:-1] == docs.columns
    n = sum(len(features(t)[0]) >= 20 for _, t in rows)
    assert sorted(r[0] for r in out.select(out.columns[-1]).collect()) == list(range(1, n // 2 + 1))


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "text string")
    assert run(make([]), none) == []
    got = run(make([(1, "a b " * 20), (2, None)]), none, 100)
    assert sorted((r[0], r[1], r[4]) for r in got) == [(1, 79, 1), (2, 0, None)]
