"""Streaming sessionization vs the batch operator; exact distributed
quantiles vs numpy."""

import os
import random

import numpy as np
from pyspark.sql import functions as F

from learnscope import fixtures as fx
from learnscope.operators import segment as sg
from learnscope.operators import stats as st
from learnscope.streaming import sessions as ss

from .conftest import SF_MID


def test_stream_sessions_match_batch_across_micro_batches(spark, tmp_path):
    turns = fx.load_view(spark, SF_MID, "turns").select("turn_id", "student_id", "asked_at", "entry")
    cut = "2024-01-15 00:00:00"
    src = tmp_path / "src"
    turns.filter(F.col("asked_at") < F.lit(cut).cast("timestamp_ntz")).coalesce(1).write.parquet(str(src / "a"))
    turns.filter(F.col("asked_at") >= F.lit(cut).cast("timestamp_ntz")).coalesce(1).write.parquet(str(src / "b"))
    files = sorted(str(p) for p in src.rglob("*.parquet"))
    stage = tmp_path / "stage"
    stage.mkdir()
    for i, f in enumerate(files):  # modification times order the micro-batches in time
        target = stage / f"part-{i}.parquet"
        target.write_bytes(open(f, "rb").read())
        os.utime(target, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(str(stage))
    q = (ss.sessionize_stream(stream, 15).writeStream.format("memory").queryName("stream_sessions")
         .option("checkpointLocation", str(tmp_path / "ckpt")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("stream_sessions").select("turn_id", "session_index")
    want = sg.segment(turns, 15).select("turn_id", "session_index")
    assert got.count() == want.count() == turns.count()
    assert got.exceptAll(want).count() == 0


def test_gap_session_windows_count(spark):
    turns = fx.load_view(spark, SF_MID, "turns")
    n = ss.gap_session_windows(turns, 15).count()
    assert n == 9774


def test_exact_quantiles_match_numpy_with_ties_and_hot_group(spark):
    random.seed(7)
    rows = [(g, float(random.choice([random.random(), 1.0, 2.0, float(random.randint(0, 50))])))
            for g in range(4) for _ in range(random.choice([1, 2, 7, 3000]))]
    rows += [(9, float(i % 3)) for i in range(20001)]  # one hot, heavily tied group
    df = spark.createDataFrame(rows, "g int, x double")
    got = {(r["g"], r["p"]): r["value"] for r in st.exact_quantiles(df, "x", ["g"], [0.25, 0.5, 0.75], accuracy=100).collect()}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x in rows if gg == g]
        for p in (0.25, 0.5, 0.75):
            assert abs(got[(g, p)] - float(np.percentile(xs, p * 100))) < 1e-12


def test_output_rounding_matches_sql_oracle(spark):
    import duckdb

    from learnscope.operators.common import round_half_away

    rng = random.Random(3)
    vals = [256.6113195, 261.5357815, -2.5e-7, 0.0000005, 1.0000005, -3.4444445, 0.1234565] + \
        [rng.uniform(-1e4, 1e4) for _ in range(3000)] + [round(rng.uniform(0, 1000), 7) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, v double")
    got = {r["i"]: r["r"] for r in df.select("i", round_half_away(F.col("v"), 6).alias("r")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    assert got == dict(con.execute("SELECT i, round(v, 6) FROM t").fetchall())


def test_session_window_merges_exact_gap_like_batch_rule(spark):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1, 9)
    rows = [(1, 1, t0), (2, 1, t0 + timedelta(minutes=15)), (3, 1, t0 + timedelta(minutes=30, microseconds=1))]
    df = spark.createDataFrame(rows, "turn_id long, student_id long, asked_at timestamp_ntz")
    sizes = sorted(r["qa_turns"] for r in ss.gap_session_windows(df, 15).collect())
    assert sizes == [1, 2]
    assert sorted(r["session_index"] for r in sg.segment(df, 15).collect()) == [1, 1, 2]


def test_lenient_time_parsing_drops_bad_rows(spark):
    rows = [(1, 1, "2024-01-01 09:00:00", "q"), (2, 1, "2024/01/01 09:05", "q"), (3, 1, "not a time", "q")]
    df = spark.createDataFrame(rows, "turn_id long, student_id long, asked_at string, question_text string")
    out = sg.clean_turns(df, time_formats=["yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm"])
    assert sorted(r["turn_id"] for r in out.collect()) == [1, 2]


def test_histogram_equals_numpy(spark):
    for n, bins in ((15, 50), (7, 20), (199, 50), (33, 20)):
        xs = [float(i) for i in range(n)] + [0.1 * i for i in range(n)]
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        got = {r["bin"]: r["count"] for r in st.histogram(df, ["x"], bins=bins).collect()}
        want, edges = np.histogram(xs, bins)
        assert [got.get(i, 0) for i in range(bins)] == want.tolist()


def test_null_class_is_a_group_of_its_own(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, None), (3, 7, 1.0), (4, 7, None), (5, 8, None)], "id long, class_id long, x double")
    got = {r["id"]: r["x"] for r in st.class_median_fill(df, ["x"]).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 1.0, 4: 1.0, 5: 3.0}


def test_log_times_in_common_forms(spark):
    texts = ["2024/1/2 9:05", "2024/01/02 09:05:00", "2024-01-02T09:05:00", " 2024-01-02 09:05 ", "1/2/2024 9:05", "2024年1月2日 9:05", "later", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(sg.parse_time("t").cast("string").alias("t"))
    assert [r["t"] for r in df.collect()] == ["2024-01-02 09:05:00"] * 6 + [None, None]
