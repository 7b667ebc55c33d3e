"""ML invariants (no SQL form for fitted models), agreement, sources."""

import numpy as np
from pyspark.sql import functions as F

from learnscope import fixtures as fx
from learnscope.operators import ml
from learnscope.sources import io

from .conftest import SF_MID

E = [f"e{i}" for i in range(1, 11)]


def test_pca_ratios_sum_to_one_and_match_covariance_eigenvalues(spark):
    z = ml.standardize(fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E), E)
    res = ml.pca_fit(z, E)
    assert abs(sum(res.ratios) - 1.0) < 1e-9
    cov = {(r["feature_i"], r["feature_j"]): r["cov"] for r in ml.covariance(z, E).collect()}
    m = np.array([[cov[(a, b)] for b in E] for a in E])
    eig = sorted(np.linalg.eigvalsh(m), reverse=True)
    assert np.allclose(np.array(eig) / sum(eig), res.ratios, atol=1e-6)
    for comp in res.loadings:  # sign rule: largest-magnitude loading positive
        assert max(comp, key=abs) > 0


def test_kmeans_inertia_matches_training_cost(spark):
    e = fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E)
    fit = ml.kmeans_best(e, E, 3, n_init=2)
    lab = ml.assign(e, E, fit.centers)
    assert abs(lab.agg(F.sum("dist2")).first()[0] - fit.cost) / fit.cost < 1e-9
    means = {r["cluster"]: [r[c] for c in E] for r in lab.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in E]).collect()}
    assert all(np.allclose(means[i], fit.centers[i], atol=0.02) for i in range(3))  # centers are nearly at rest


def test_many_models_in_one_pass_equal_single_fits(spark):
    e = fx.embeddings_matrix(spark, SF_MID).select(*E).repartition(4)
    specs = [(2, 1), (3, 2), (3, 3), (5, 4)]
    together = ml.fit_many(e, E, specs)
    for spec, f in zip(specs, together):
        (alone,) = ml.fit_many(e, E, [spec])
        assert np.allclose(f.centers, alone.centers) and abs(f.cost - alone.cost) < 1e-6 * f.cost


def test_a_pass_reads_one_column(spark):
    """However many coordinates a row has; its numbers are those of numpy."""
    x = np.random.default_rng(4).normal(size=(300, 20))
    cols = [f"c{j}" for j in range(20)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    rows = ml.packed(df, cols)
    assert len(rows.columns) == 1 and ml.packed(rows, cols) is rows
    for source in (df, rows):
        out = ml.lloyd_pass(source, cols, [x[:3], x[5:9]])
        for c, (n, s, e) in zip((x[:3], x[5:9]), out):
            d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            label = d.argmin(axis=1)
            assert n.tolist() == np.bincount(label, minlength=len(c)).tolist()
            assert np.allclose(s, [x[label == k].sum(axis=0) for k in range(len(c))])
            assert np.allclose(e, [d[label == k].min(axis=1).sum() for k in range(len(c))])
    none = ml.lloyd_pass(df.filter("c0 > 1e9"), cols, [x[:3]])
    assert none[0][0].tolist() == [0, 0, 0] and not none[0][1].any()


def test_lloyd_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    start = c = x[[0, 60, 120]]
    for _ in range(300):
        lab = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        c = np.array([x[lab == k].mean(0) for k in range(3)])
    (got, cost), = ml.lloyd(df, ["a", "b"], [start], tol=0.0)
    assert np.allclose(got, c) and abs(cost - ((x - c[lab]) ** 2).sum()) < 1e-9


def test_ari_of_huge_counts_and_null_labels(spark):
    g = spark.createDataFrame([(0, 0, 4_000_000_000), (0, 1, 3), (1, 1, 4_000_000_000)], "a int, b int, nij long")
    assert 0.99 < ml._ari_from_counts(g, []).first()["ari"] <= 1.0
    df = spark.createDataFrame([(0, None), (0, None), (1, 5), (1, 5)], "a int, b int")
    assert ml.ari_pairwise(df, ["a", "b"]).first()["ari"] == 1.0


def test_k_sweep_and_elbow(spark):
    e = fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E)
    sweep = ml.k_sweep(e, E, e.count(), max_k=5, n_init=2)
    rows = sorted((r["k"], r["inertia"]) for r in sweep.collect())
    assert [k for k, _ in rows] == [2, 3, 4, 5]
    assert all(b <= a * 1.05 for (_, a), (_, b) in zip(rows, rows[1:]))
    k = ml.elbow(sweep).first()["k"]
    assert k in (3, 4)


def test_elbow_table_and_short_curves(spark):
    t = spark.createDataFrame([(k, 1000.0 / k) for k in range(2, 11)], "k int, inertia double")
    r = ml.elbow(t).first()
    assert r["k"] == 3 and abs(r["change"] - 83.333333) < 1e-5
    short = spark.createDataFrame([(2, 5.0), (3, 4.0)], "k int, inertia double")
    assert ml.elbow(short).first()["k"] == 2


def test_ari_identity_symmetry_and_pairs(spark):
    e = fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E).withColumn("s", (F.col("e1") > 0).cast("int"))
    assert ml.ari(e, "label", "label").first()["ari"] == 1.0
    a, b = ml.ari(e, "label", "s").first()["ari"], ml.ari(e, "s", "label").first()["ari"]
    assert abs(a - b) < 1e-12
    pw = {(r["i"], r["j"]): r["ari"] for r in ml.ari_pairwise(e, ["label", "s", "label"]).collect()}
    assert pw[(0, 2)] == 1.0 and abs(pw[(0, 1)] - a) < 1e-12


def test_select_components_never_reached_gives_one(spark):
    t = spark.createDataFrame([(1, 0.5), (2, 0.3), (3, 0.2)], "pc int, ratio double")
    assert ml.select_components(t, 0.8).first()["n_components"] == 2
    assert ml.select_components(t, 1.5).first()["n_components"] == 1


def test_session_path_filter(spark, tmp_path):
    base = tmp_path / "tree"
    for rel in ["dialogs/s1.csv", "dialogs/feature_stats.csv", "clustering_results/x.csv", "dialogs/sub/PCA_out.csv", "dialogs/s2.csv"]:
        p = base / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text('﻿"学生ID","提问时间","提问内容"\n"1","2024-01-01 09:00:00","a ""q""\nline2"\n', encoding="utf-8")
    df = io.session_path_filter(io.read_turns_csv(spark, str(base), recursive=True))
    names = sorted(r["source"] for r in df.select("source").distinct().collect())
    assert names == ["dialogs/s1.csv", "dialogs/s2.csv"]
    row = df.first()
    assert row["question_text"] == 'a "q" line2' and row["student_id"] == "1"


def test_required_columns_reports_all_missing(spark):
    import pytest

    df = spark.range(1)
    with pytest.raises(ValueError, match="student_id.*cluster"):
        io.required_columns(df, ["student_id", "cluster"])


def test_binary_columns_pass_through_and_top_loadings(spark):
    e = fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E).withColumn("flag", (F.col("e1") > 0).cast("int"))
    z = ml.standardize(e, [*E, "flag"], binary=["flag"])
    assert {r["flag"] for r in z.select("flag").distinct().collect()} <= {0.0, 1.0}
    top = ml.top_loadings(ml.pca_table(spark, ml.pca_fit(ml.standardize(e, E), E)))
    assert top.count() == 10 and top.columns == ["feature", "PC1", "PC2", "PC3"]


def test_stats_json_sink(spark, tmp_path):
    df = spark.createDataFrame([(3, 2)], "total long, processed long")
    io.write_json(df, str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).first()["processed"] == 2


def test_jitter_constant_is_seeded_and_only_touches_constant_columns(spark):
    df = fx.load_view(spark, SF_MID, "dirty_features").select("event_id", "f_const", F.coalesce("f_all_null_class", F.lit(0.0)).alias("g"))
    a = ml.jitter_constant(df, ["f_const", "g"], seed=7)
    b = ml.jitter_constant(df, ["f_const", "g"], seed=7)
    assert a.agg(F.var_samp("f_const")).first()[0] > 0
    assert a.select("event_id", "f_const", "g").exceptAll(b.select("event_id", "f_const", "g")).count() == 0
    assert a.select("g").exceptAll(df.select("g")).count() == 0


def test_render_prompt_wraps_payload(spark):
    from learnscope.operators import segment as sg

    r = spark.createDataFrame([('[{"row_number": 1}]',)], "payload string").select(sg.render_prompt("payload").alias("p")).first()["p"]
    assert r.startswith(sg.PROMPT_HEADER) and r.endswith('[{"row_number": 1}]')


def test_files_are_read_under_their_own_headers(spark, tmp_path):
    from learnscope.operators import segment as sg

    def put(rel, text):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text(text, encoding="utf-8")

    put("x/log.csv", "学生ID,提问时间,提问内容\n1,2024-01-01 09:00:00,q1\n")
    put("y/log.csv", "提问内容, 提问时间 ,学生ID,其他\nq2,2024/1/1 9:05,1,z\n")
    put("y/no_time.csv", "学生ID,提问内容\n1,lost\n")
    put("y/no_rows.csv", "学生ID,提问时间,提问内容\n")
    t = io.read_turns_csv(spark, str(tmp_path), recursive=True)
    got = sorted((r["source"], r["student_id"], r["question_text"], str(r["asked_at"])) for r in t.collect())
    assert got == [("x/log.csv", "1", "q1", "2024-01-01 09:00:00"), ("y/log.csv", "1", "q2", "2024-01-01 09:05:00")]
    assert sg.segment(t, 15).select("source", "session_index").distinct().count() == 2  # one student, two files, two sessions
    bad = {r["file"].rsplit("/", 1)[1]: (r["reason"], r["missing"]) for r in io.rejected_files(spark, str(tmp_path), recursive=True).collect()}
    assert bad == {"no_time.csv": ("missing_columns", ["asked_at"]), "no_rows.csv": ("empty", [])}
    more = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in io.rejected_files(spark, str(tmp_path), recursive=True, required=["asked_at"], session_files=True).collect()}
    assert more["log.csv"] == "missing_class"


def test_no_header_name_is_left_out(spark, tmp_path):
    from learnscope.sources import io

    known = list(io.REQUIRED_TURN_COLUMNS)
    for i in range(20):
        names = [*known, *(f"x{i}_{j}" for j in range(55))]
        (tmp_path / f"f{i}.csv").write_text(",".join(names) + "\n" + ",".join("v" for _ in names) + "\n", encoding="utf-8")
    got = set(io.read_turns_csv(spark, str(tmp_path), clean=False).columns)
    assert {*known, *(f"x{i}_{j}" for i in range(20) for j in range(55))} <= got


def test_starts_find_a_small_far_group(spark):
    """Three rows of 60,000, far away: outside any small sample, yet a cluster."""
    import numpy as np

    df = spark.range(60_003).select((F.randn(1) + F.when(F.col("id") < 3, 1000.0).otherwise(0.0)).alias("a"), F.randn(2).alias("b")).repartition(6).checkpoint()
    points, weights = ml.candidates(df, ["a", "b"])
    assert weights.sum() == 60_003 and len(points) <= ml.CANDIDATES * ml.ROUNDS and (points[:, 0] > 900).sum() == 3
    fits = ml.fit_many(df, ["a", "b"], [(2, seed) for seed in range(5)])
    assert all(c.centers[:, 0].max() > 900 for c in fits)
    again, _ = ml.candidates(df, ["a", "b"])
    assert np.array_equal(points, again)


def test_candidates_of_repeated_and_missing_rows(spark):
    import pytest

    df = spark.createDataFrame([(1.0, 1.0)] * 500 + [(2.0, 2.0)] + [(None, 1.0)], "a double, b double")
    points, weights = ml.candidates(df.filter("a is not null"), ["a", "b"])
    assert points.tolist() == [[1.0, 1.0], [2.0, 2.0]] and weights.tolist() == [500, 1]
    assert sorted(map(tuple, ml.fit_many(df.filter("a is not null"), ["a", "b"], [(2, 1)])[0].centers.tolist())) == [(1.0, 1.0), (2.0, 2.0)]
    with pytest.raises(ValueError, match="no rows"):
        ml.candidates(df.filter("a > 5"), ["a", "b"])


def test_covariance_of_large_means(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 1]]) + 1e8
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double").repartition(7)
    got = {(r["feature_i"], r["feature_j"]): r["cov"] for r in ml.covariance(df, ["a", "b", "c"]).collect()}
    want = np.cov((x - 1e8).T, bias=True)
    assert all(abs(got["abc"[i], "abc"[j]] - want[i, j]) < 1e-6 for i in range(3) for j in range(3))


def test_preview_and_top_ratios(spark):
    from learnscope.operators import profile as pf

    df = spark.createDataFrame([(c, i) for i, c in enumerate([3, None, 1, 2, 1, 9])], "c int, i int")
    assert [(r["c"], r["i"], r["position"]) for r in pf.preview(df, ["c", "i"], 4).orderBy("position").collect()] == [(1, 2, 1), (1, 4, 2), (2, 3, 3), (3, 0, 4)]
    assert pf.preview(df.limit(0), ["c"]).count() == 0
    e = fx.embeddings_matrix(spark, SF_MID).select("vec_id", "label", *E)
    top = sorted(tuple(r) for r in ml.top_ratios(ml.pca_table(spark, ml.pca_fit(ml.standardize(e, E), E))).collect())
    assert [t[0] for t in top] == [1, 2, 3, 4, 5, 6]
    assert all(abs(t[2] - sum(u[1] for u in top[: i + 1])) < 1e-9 for i, t in enumerate(top))


def test_session_table_is_zstd_and_holds_whole_texts(spark, tmp_path):
    import datetime as dt

    import pyarrow.parquet as pq

    from learnscope.plans.q_sources import snk_sessions

    at = dt.datetime(2024, 1, 1)
    events = [(i, at + dt.timedelta(minutes=10 * i), i % 3, "click", 1.0, "{}") for i in range(60)]
    texts = [(d, f"Frage {d} über Wärme " * 400, "de", "s", 0) for d in range(7)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = snk_sessions(spark, str(tmp_path))
    got = {r["turn_id"]: (r["student_id"], r["class_id"], r["session_index"]) for r in out.collect()}
    assert got == {i: (i % 3, i % 3, i // 3 + 1) for i in range(60)}  # 30 minutes between a student's turns
    files = [f.removeprefix("file:") for f in out.inputFiles()]
    parts = [pq.ParquetFile(f) for f in files]
    assert {p.metadata.row_group(0).column(c).compression for p in parts for c in range(p.metadata.num_columns)} == {"ZSTD"}
    whole = {r["turn_id"]: r["question_text"] for p in parts for r in p.read(["turn_id", "question_text"]).to_pylist()}
    assert len(whole) == 60 and all(whole[i].startswith(texts[i % 7][1] + " ") for i in range(60))


def test_sums_by_product_are_those_of_the_labels():
    """Counts and sums of a pass, also on ties (the first center), without rows, and
    with centers out of range."""
    rng = np.random.default_rng(1)
    for k, m, p, n, ties in ((5, 20, 7, 3000, False), (5, 20, 3, 3000, True), (7, 4, 2, 800, True), (3, 2, 1, 0, False)):
        x = rng.integers(0, 3, (n, p)).astype(float) if ties else rng.standard_normal((n, p))
        c = np.stack([x[rng.choice(n, k)] if n else np.zeros((k, p)) for _ in range(m)])
        c[0, -1] = np.nan if ties else c[0, -1]
        want, got = ml._sums_by_label(x, c, False), ml._sums_by_product(x, c)
        assert np.array_equal(want[0], got[0]) and np.allclose(want[2], got[2], rtol=0, atol=1e-9)
        assert got[0].sum() == n * m


def test_a_pass_moves_batches_not_rows(spark):
    """Rows with a missing coordinate are counted as before: in the first cluster."""
    df = spark.range(25_000).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") != 7, -F.col("id")).cast("int").alias("b")).coalesce(1)
    assert ml.packed(df, ["a", "b"]).count() == 3
    (n, s, _), = ml.lloyd_pass(df, ["a", "b"], [np.array([[0.0, 0.0], [20_000.0, -20_000.0]])], cost=False)
    assert n.tolist() == [10_001, 14_999] and s[1, 0] == sum(range(10_001, 25_000)) and np.isnan(s[0, 1])
