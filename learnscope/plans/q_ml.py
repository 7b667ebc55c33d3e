"""ML and cluster-profile queries. SQL-checkable parts run on the whole
``embeddings`` matrix and on SQL-derivable labelings. The fitted parts (PCA,
K-Means) have no SQL form; ``ml_pca_checks`` and ``ml_lloyd_steps`` hold what
they must satisfy against SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import lexicon as L
from ..operators import ml
from ..operators import profile as pf
from ..session import scratch_path
from ..sources import io
from . import common as C
from . import oracle_sql as O
from .stages import cluster_sessions, prepared_session_matrix
from .registry import register

E = [f"e{i}" for i in range(1, fx.EMBED_DIMS + 1)]
_EMB = "emb AS (SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, fx.EMBED_DIMS + 1)) + " FROM embeddings)"
_STATS = "st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in E) + " FROM emb)"
_Z = "z AS (SELECT vec_id, label, " + ", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS {c}" for c in E) + " FROM emb CROSS JOIN st)"


def _emb(spark, sf):
    return fx.embeddings_matrix(spark, sf)


@register("ml_standardize", O.with_(_EMB, _STATS, _Z) + "SELECT * FROM z", floats=tuple(E))
def ml_standardize(spark, sf):
    """ML1-2: z-scores (population std) of all feature columns."""
    return ml.standardize(_emb(spark, sf), E, keep=["vec_id", "label"])


_LONG = "l AS (SELECT vec_id, label, i, 'e' || i AS feature, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"
_ZL = "zl AS (SELECT vec_id, feature, CASE WHEN s > 0 THEN (x - m) / s ELSE 0.0 END AS z FROM (SELECT *, avg(x) OVER w AS m, stddev_pop(x) OVER w AS s FROM l WINDOW w AS (PARTITION BY i)))"


@register("ml_covariance", O.with_(_LONG, _ZL) + "SELECT a.feature AS feature_i, b.feature AS feature_j, covar_pop(a.z, b.z) AS cov FROM zl a JOIN zl b USING (vec_id) GROUP BY 1, 2", floats=("cov",))
def ml_covariance(spark, sf):
    """ML3: covariance matrix of the standardized columns (long form)."""
    return ml.covariance(ml.standardize(_emb(spark, sf), E), E)


_RATIOS = """p AS (SELECT CAST(row_number() OVER (ORDER BY v DESC, feature) AS INTEGER) AS pc, v AS ratio FROM (SELECT feature, var_pop(x) AS v FROM l GROUP BY feature)),
c AS (SELECT pc, sum(ratio / (SELECT sum(ratio) FROM p)) OVER (ORDER BY pc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative FROM p),
th AS (SELECT * FROM (VALUES (0.8), (1.5)) AS t(threshold))"""


@register("ml_select_components", O.with_(_LONG, _RATIOS) + """
SELECT threshold, CAST(coalesce(min(pc) FILTER (WHERE cumulative >= threshold), 1) AS INTEGER) AS n_components,
  coalesce(arg_min(cumulative, pc) FILTER (WHERE cumulative >= threshold), arg_max(cumulative, pc)) AS variance
FROM th CROSS JOIN c GROUP BY threshold""", floats=("threshold", "variance"))
def ml_select_components(spark, sf):
    """WIN6 + ML6: axes needed for 80% (and an unreachable 150%) of the variance
    of the embeddings, with the coordinate axes in order of their variance."""
    e = _emb(spark, sf)
    var = e.agg(*[F.var_pop(c).alias(c) for c in E]).unpivot([], E, "feature", "ratio")
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("ratio").desc(), "feature")  # one row per axis
    ratios = var.select(F.row_number().over(w).cast("int").alias("pc"), "ratio")
    return ml.select_components(ratios, 0.8).unionByName(ml.select_components(ratios, 1.5))


_SWEEP = """g AS (SELECT k, label % k AS c, feature, avg(x) AS m FROM l CROSS JOIN (SELECT unnest(range(2, 11)) AS k) GROUP BY ALL),
s AS (SELECT k, sum((x - m) * (x - m)) AS inertia FROM l JOIN g ON g.feature = l.feature AND g.c = l.label % g.k GROUP BY k),
o AS (SELECT k, inertia, lag(k) OVER w AS pk, lag(inertia) OVER w AS pi, lead(k) OVER w AS nk, lead(inertia) OVER w AS ni FROM s WINDOW w AS (ORDER BY k)),
ch AS (SELECT k, abs(abs((ni - inertia) / (nk - k)) - abs((inertia - pi) / (k - pk))) AS change FROM o)"""


@register("ml_elbow", O.with_(_LONG, _SWEEP) + """SELECT CAST(coalesce((SELECT k FROM ch WHERE change IS NOT NULL ORDER BY change DESC, k LIMIT 1), (SELECT min(k) FROM ch)) AS INTEGER) AS k,
  (SELECT max(change) FROM ch) AS change""",
          floats=("change",))
def ml_elbow(spark, sf):
    """WIN7: slope-change elbow over the inertia of the partitions label mod K
    of the embeddings, K = 2..10."""
    x = _emb(spark, sf).unpivot(["vec_id", "label"], E, "feature", "x").withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(10))))
    g = x.groupBy("k", (F.col("label") % F.col("k")).alias("c"), "feature").agg((F.count("x") * F.var_pop("x")).alias("sse"))
    return ml.elbow(g.groupBy("k").agg(F.sum("sse").alias("inertia")))


_CENT = "cen AS (SELECT label, " + ", ".join(f"avg({c}) AS c_{c}" for c in E) + " FROM emb GROUP BY label)"
_D2 = " + ".join(f"(emb.{c} - cen.c_{c}) * (emb.{c} - cen.c_{c})" for c in E)


@register("ml_inertia", O.with_(_EMB, _CENT) + f"SELECT emb.label, count(*) AS n, sum({_D2}) AS sse FROM emb JOIN cen ON emb.label = cen.label GROUP BY emb.label",
          floats=("sse",))
def ml_inertia(spark, sf):
    """ML8: within-cluster sum of squares of the label partition."""
    e = _emb(spark, sf)
    centers = e.groupBy("label").agg(*[F.avg(c).alias(c) for c in E])
    return ml.inertia(e, E, "label", centers)


@register("ml_assign", O.with_(_EMB, _CENT, f"d AS (SELECT emb.vec_id, cen.label AS c, {_D2} AS d2 FROM emb CROSS JOIN cen)")
          + "SELECT vec_id, CAST(arg_min(c, (d2, c)) AS INTEGER) AS cluster, min(d2) AS dist2 FROM d GROUP BY vec_id",
          floats=("dist2",))
def ml_assign(spark, sf):
    """ML9: nearest of the per-label centroids (K x p numbers inlined)."""
    e = _emb(spark, sf)
    rows = e.groupBy("label").agg(*[F.avg(c).alias(c) for c in E]).orderBy("label").collect()  # K x p
    k = max(r["label"] for r in rows) + 1
    centers = [[0.0] * len(E) for _ in range(k)]
    present = set()
    for r in rows:
        centers[r["label"]] = [r[c] for c in E]
        present.add(r["label"])
    centers = [c if i in present else [float("inf")] * len(E) for i, c in enumerate(centers)]
    return ml.assign(e, E, centers).select("vec_id", "cluster", "dist2")


_LABELINGS = {
    "label": "label",
    "sign12": "CAST((e1 > 0) AS INTEGER) * 2 + CAST((e2 > 0) AS INTEGER)",
    "sign_all": "(" + " + ".join(f"CAST((e{i} > 0) AS INTEGER)" for i in range(1, fx.EMBED_DIMS + 1)) + ") % 7",
    "label_mod3": "label % 3",
}
_LAB = "lab AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in _LABELINGS.items()) + " FROM emb)"


def _ari_sql(a: str, b: str, extra: str = "") -> str:
    return f"""SELECT {extra}CASE WHEN sa - ss = 0 AND sb - ss = 0 THEN 1.0 ELSE
  2.0 * ((ss - n) * (n * n - (sb - ss) - (sa - ss) - ss) - (sa - ss) * (sb - ss)) /
  (((ss - n) + (sa - ss)) * ((sa - ss) + (n * n - (sb - ss) - (sa - ss) - ss)) + ((ss - n) + (sb - ss)) * ((sb - ss) + (n * n - (sb - ss) - (sa - ss) - ss))) END AS ari
FROM (SELECT CAST(sum(nij * nij) AS DOUBLE) AS ss, CAST(sum(nij) AS DOUBLE) AS n,
  CAST((SELECT sum(x * x) FROM (SELECT sum(nij) AS x FROM (SELECT {a} AS a, {b} AS b, count(*) AS nij FROM lab GROUP BY 1, 2) GROUP BY a)) AS DOUBLE) AS sa,
  CAST((SELECT sum(x * x) FROM (SELECT sum(nij) AS x FROM (SELECT {a} AS a, {b} AS b, count(*) AS nij FROM lab GROUP BY 1, 2) GROUP BY b)) AS DOUBLE) AS sb
  FROM (SELECT {a} AS a, {b} AS b, count(*) AS nij FROM lab GROUP BY 1, 2))"""


def _labelled(spark, sf):
    e = _emb(spark, sf)
    return e.select("*", *[F.expr(v).cast("int").alias(k) for k, v in _LABELINGS.items() if k != "label"])


@register("ml_ari", O.with_(_EMB, _LAB) + _ari_sql("label", "sign12"), floats=("ari",))
def ml_ari(spark, sf):
    """ML11: ARI of the embedding label vs a sign-bit labeling."""
    return ml.ari(_labelled(spark, sf), "label", "sign12")


_NAMES = list(_LABELINGS)
_PAIRS = " UNION ALL ".join(_ari_sql(a, b, f"{i} AS i, {j} AS j, ") for i, a in enumerate(_NAMES) for j, b in enumerate(_NAMES) if i < j)


@register("ml_ari_pairwise", O.with_(_EMB, _LAB) + _PAIRS, floats=("ari",))
def ml_ari_pairwise(spark, sf):
    """JOIN6 + ML11: ARI of every pair of four SQL-derivable labelings."""
    return ml.ari_pairwise(_labelled(spark, sf), _NAMES)


# ------------------------------------------------------------------ fitted (no SQL form)


@register("ml_pca_scores")
def ml_pca_scores(spark, sf):
    """ML4: PCA scores of the standardized embedding matrix."""
    z = ml.standardize(_emb(spark, sf), E, keep=["vec_id"])
    return ml.pca_scores(z, ml.pca_fit(z, E), keep=["vec_id"])


@register("ml_pca_loadings")
def ml_pca_loadings(spark, sf):
    """ML5 + SRT4: loadings, explained-variance ratios and cumulative ratios."""
    z = ml.standardize(_emb(spark, sf), E)
    return ml.pca_table(spark, ml.pca_fit(z, E))


@register("ml_pca_checks", O.with_(_LONG, _ZL) + """SELECT 'variance_total' AS check_name, (SELECT sum(v) FROM (SELECT var_pop(z) AS v FROM zl GROUP BY feature)) AS value
  UNION ALL SELECT 'ratio_sum', 1.0 UNION ALL SELECT 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM embeddings)
  UNION ALL SELECT 'eigen_residual', 0.0 UNION ALL SELECT 'loadings_not_orthonormal', 0.0 UNION ALL SELECT 'scores_correlated', 0.0
  UNION ALL SELECT 'top_ratio_over_share', 0.0""", floats=("value",))
def ml_pca_checks(spark, sf):
    """ML4-5 + SRT4 against SQL: the score variances add up to the variance of
    the input, loadings are orthonormal eigenvectors of its covariance, scores
    are uncorrelated, ratios are the eigenvalues' shares, largest first."""
    import numpy as np

    z = ml.standardize(_emb(spark, sf), E, keep=["vec_id"]).persist()
    res = ml.pca_fit(z, E)
    v = np.array(res.loadings).T
    pc = [f"pc{i + 1}" for i in range(len(E))]

    def square(df, cols):  # p x p numbers
        m = {(r["feature_i"], r["feature_j"]): r["cov"] for r in ml.covariance(df, cols).collect()}
        return np.array([[m[a, b] for b in cols] for a in cols])

    scores = ml.pca_scores(z, res, keep=["vec_id"])
    cov, sc, n = square(z, E), square(scores, pc), float(scores.count())
    z.unpersist()
    lam = np.diag(sc)
    rows = [
        ("variance_total", float(lam.sum())),
        ("ratio_sum", float(sum(res.ratios))),
        ("rows", n),
        ("eigen_residual", float(np.abs(cov @ v - v * lam).max())),
        ("loadings_not_orthonormal", float(np.abs(v.T @ v - np.eye(len(E))).max())),
        ("scores_correlated", float(np.abs(sc - np.diag(lam)).max())),
        ("top_ratio_over_share", float(np.abs(np.array(res.ratios) - np.sort(lam)[::-1] / lam.sum()).max())),
    ]
    return spark.createDataFrame(rows, "check_name string, value double")


_STEP = """d{j} AS (SELECT l.vec_id, c.c, sum((x - m) * (x - m)) AS d2 FROM l JOIN c{i} c ON l.feature = c.feature GROUP BY ALL),
a{j} AS (SELECT vec_id, arg_min(c, (d2, c)) AS c, min(d2) AS d2 FROM d{j} GROUP BY vec_id),
c{j} AS (SELECT a.c, feature, avg(x) AS m FROM l JOIN a{j} a USING (vec_id) GROUP BY ALL)"""


@register("ml_lloyd_steps", O.with_(_LONG, "c0 AS (SELECT label AS c, feature, avg(x) AS m FROM l WHERE label < 4 GROUP BY ALL)", *[_STEP.format(i=i, j=i + 1) for i in range(3)])
          + " UNION ALL ".join(f"SELECT {i} AS step, CAST(c AS INTEGER) AS cluster, count(*) AS n, sum(d2) AS sse FROM a{i + 1} GROUP BY c" for i in range(3)),
          floats=("sse",))
def ml_lloyd_steps(spark, sf):
    """ML7-10: the first three K-Means iterations from the centroids of labels
    0..3, by the pass that all fits use."""
    e = _emb(spark, sf)
    start = e.filter("label < 4").groupBy("label").agg(*[F.avg(c).alias(c) for c in E]).orderBy("label").collect()  # 4 x p
    return ml.lloyd_steps(e, E, [[r[c] for c in E] for r in start], 3)


@register("ml_k_sweep")
def ml_k_sweep(spark, sf):
    """ML7: inertia per K on the session-feature PCA projection."""
    mat = prepared_session_matrix(spark, sf)
    return ml.k_sweep(mat.df, mat.cols, mat.n_rows, L.MAX_K, L.N_INIT)


@register("ml_cluster")
def ml_cluster(spark, sf):
    """ML10 (+ML6/WIN7): session types from the full clustering pipeline."""
    res = cluster_sessions(spark, sf, stability_iterations=0)
    return res.labels.select("student_id", "session_index", "class_id", "cluster")


@register("ml_stability")
def ml_stability(spark, sf):
    """ML12 + AGG35 + SCL19 + SNK8: K-Means stability over refits: the summary
    and all pairwise scores, written as a report and read back."""
    res = cluster_sessions(spark, sf)
    path = scratch_path(spark, "stability-report")
    one = res.stability.select(F.lit("summary").alias("part"), F.lit(None).cast("int").alias("i"), F.lit(None).cast("int").alias("j"), F.col("mean_ari").alias("ari"),
                               "iterations", "n_pairs", "std_ari", "min_ari", "stability")
    pairs = res.pairwise.select(F.lit("pair").alias("part"), "i", "j", "ari")
    io.write_table(one.unionByName(pairs, allowMissingColumns=True), path)
    return io.read_table(spark, path, ["part", "ari"])


# Far groups: 1,000 apart in one coordinate, so the best clusters are the labels themselves.
_FAR = "far AS (SELECT * REPLACE (e1 + 1000.0 * label AS e1) FROM emb WHERE label IS NOT NULL)"
_FAR_G = "fg AS (SELECT label, count(*) AS n, " + ", ".join(f"avg({c}) AS {c}" for c in E) + ", " + " + ".join(f"count(*) * var_pop({c})" for c in E) + " AS sse FROM far GROUP BY label)"


@register("ml_fit_far", O.with_(_EMB, _FAR, _FAR_G) + f"""SELECT 'cluster' AS part, CAST(row_number() OVER (ORDER BY n DESC, e1) - 1 AS INTEGER) AS i, CAST(NULL AS INTEGER) AS j, n, e1 AS first, e{len(E)} AS last, sse AS value, CAST(NULL AS VARCHAR) AS stability FROM fg
  UNION ALL SELECT 'sweep', CAST(count(*) AS INTEGER), NULL, CAST(sum(n) AS BIGINT), NULL, NULL, sum(sse), NULL FROM fg
  UNION ALL SELECT 'pair', CAST(a.i AS INTEGER), CAST(b.i AS INTEGER), NULL, NULL, NULL, 1.0, NULL FROM range({L.STABILITY_ITERATIONS}) a(i) JOIN range({L.STABILITY_ITERATIONS}) b(i) ON a.i < b.i
  UNION ALL SELECT 'summary', {L.STABILITY_ITERATIONS}, NULL, {L.STABILITY_ITERATIONS * (L.STABILITY_ITERATIONS - 1) // 2}, 0.0, 1.0, 1.0, 'Highly Stable'""",
          floats=("first", "last", "value"))
def ml_fit_far(spark, sf):
    """ML7, ML10, ML12, SNK8 to the end against SQL: with the labels' groups moved
    far apart, the last K of the sweep, the final clusters (sizes, centers,
    inertia) and every refit must find exactly the labels. The scores are
    written as a report and read back."""
    e = _emb(spark, sf).filter("label is not null").withColumn("e1", F.col("e1") + 1000.0 * F.col("label"))
    n, k = e.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    sweep = ml.k_sweep(e, E, n, k, min_k=k).select(F.lit("sweep").alias("part"), F.col("k").alias("i"), F.lit(n).cast("long").alias("n"), F.col("inertia").alias("value"))
    labels, centers = ml.cluster(e, E, k)
    center = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centers)], "cluster int, " + ", ".join(f"{c} double" for c in E))
    found = ml.inertia(labels, E, "cluster", center).join(center, "cluster")
    found = found.select(F.lit("cluster").alias("part"), F.col("cluster").alias("i"), "n", F.col("e1").alias("first"), F.col(E[-1]).alias("last"), F.col("sse").alias("value"))
    summary, pairs = ml.stability(e, E, k)
    summary = summary.select(F.lit("summary").alias("part"), F.col("iterations").alias("i"), F.col("n_pairs").alias("n"), F.col("std_ari").alias("first"), F.col("min_ari").alias("last"),
                             F.col("mean_ari").alias("value"), "stability")
    pairs = pairs.select(F.lit("pair").alias("part"), "i", "j", F.col("ari").alias("value"))
    path = scratch_path(spark, "fit-report")
    every = [found, sweep, pairs, summary]
    out = every[0]
    for df in every[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    io.write_table(out, path)
    return io.read_table(spark, path, ["part", "value"]).select("part", "i", "j", "n", "first", "last", "value", "stability")


@register("ml_fit_checks", O.with_(_LONG) + f"""SELECT 'total_squares' AS check_name, (SELECT sum(v) FROM (SELECT count(*) * var_pop(x) AS v FROM l GROUP BY feature)) AS value
  UNION ALL SELECT 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM embeddings) UNION ALL SELECT 'fits', {L.N_INIT}.0
  UNION ALL SELECT 'rows_off_nearest_center', 0.0 UNION ALL SELECT 'centers_off_means', 0.0 UNION ALL SELECT 'inertia_off', 0.0
  UNION ALL SELECT 'starts_below_best', 0.0 UNION ALL SELECT 'sweep_rises', 0.0""", floats=("value",))
def ml_fit_checks(spark, sf):
    """ML7-10: what a finished fit of the embeddings must satisfy, recomputed from
    its labels with DataFrame functions: squares within and between clusters add up
    to all squares, every row has its nearest center, centers are their rows' means,
    the reported inertia is that of the labels, the best of ten is below the others,
    and the sweep's inertia never rises with K."""
    e, k = _emb(spark, sf), 5
    fits = ml.fit_many(e, E, [(k, L.RANDOM_STATE + i) for i in range(L.N_INIT)], tol=1e-12)
    best = min(fits, key=lambda f: f.cost)
    lab = ml.assign(e, E, best.centers).persist()
    center = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(best.centers)], "cluster int, " + ", ".join(f"{c} double" for c in E))
    sse = ml.inertia(lab, E, "cluster", center).agg(F.sum("sse")).first()[0]
    row = F.array(*E)
    d2 = [F.aggregate(F.zip_with(row, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) for c in best.centers]
    off = lab.withColumn("__d", F.array(*d2)).filter(F.get("__d", F.col("cluster")) > F.array_min("__d") + 1e-9).count()
    means = lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in E]).collect()  # k rows
    whole = lab.agg(*[F.avg(c) for c in E]).first()
    n = lab.count()
    lab.unpersist()
    between = sum(r["n"] * sum((r[c] - m) ** 2 for c, m in zip(E, whole)) for r in means)
    apart = max(abs(r[c] - best.centers[r["cluster"]][j]) for r in means for j, c in enumerate(E))
    sweep = [r["inertia"] for r in ml.k_sweep(e, E, n).orderBy("k").collect()]
    rows = [
        ("total_squares", sse + between),
        ("rows", float(n)),
        ("fits", float(len(fits))),
        ("rows_off_nearest_center", float(off)),
        ("centers_off_means", apart),
        ("inertia_off", abs(best.cost - sse) / sse if sse else abs(best.cost)),
        ("starts_below_best", float(sum(f.cost < best.cost for f in fits))),
        ("sweep_rises", float(sum(b > a for a, b in zip(sweep, sweep[1:])))),
    ]
    return spark.createDataFrame([(name, float(v)) for name, v in rows], "check_name string, value double")


@register("ml_ari_summary", O.with_(_EMB, _LAB, f"pw AS ({_PAIRS})")
          + f"""SELECT count(*) AS n_pairs, avg(ari) AS mean_ari, stddev_pop(ari) AS std_ari, min(ari) AS min_ari,
                 CASE WHEN avg(ari) > {L.STABILITY_HIGH} THEN 'Highly Stable' WHEN avg(ari) > {L.STABILITY_MODERATE} THEN 'Moderately Stable' ELSE 'Unstable' END AS stability FROM pw""",
          floats=("mean_ari", "std_ari", "min_ari"))
def ml_ari_summary(spark, sf):
    """AGG35 + SCL19: mean, spread, minimum and label of pairwise agreement."""
    return ml.ari_summary(ml.ari_pairwise(_labelled(spark, sf), _NAMES))


# ------------------------------------------------------------------ cluster profiles

_FEAT_IMP = [*O.features_ctes(720), *O.imputed_ctes(), "pcl AS (SELECT *, CAST(is_exam_week * 2 + is_in_class_time AS INTEGER) AS cluster FROM imp)"]


def _profiled(spark, sf, columns=None):
    need = None if columns is None else [*columns, "is_exam_week", "is_in_class_time"]
    f = C.raw_features(spark, sf, columns=need)
    return f.withColumn("cluster", (F.col("is_exam_week") * 2 + F.col("is_in_class_time")).cast("int"))


@register("clu_sizes", O.with_(*O.views("clustered"))
          + "SELECT cluster, count(*) AS n, count(*) / sum(count(*)) OVER () AS share, CAST(row_number() OVER (ORDER BY count(*) DESC, cluster) AS INTEGER) AS position FROM clustered GROUP BY cluster",
          floats=("share",))
def clu_sizes(spark, sf):
    """AGG25 + SRT3: cluster sizes and shares, largest first."""
    return pf.cluster_sizes(C.clustered(spark, sf))


_PCMEAN = ", ".join(f"avg({c}) AS {c}" for c in E)


@register("clu_centroids", O.with_(_EMB) + f"SELECT label AS cluster, {_PCMEAN} FROM emb GROUP BY label", floats=tuple(E))
def clu_centroids(spark, sf):
    """AGG26: cluster centroids in all coordinates."""
    return pf.cluster_centroids(_emb(spark, sf).withColumnRenamed("label", "cluster"), cols=E)


@register("clu_turns_box", O.with_(*_FEAT_IMP, """b AS (SELECT cluster, avg(qa_turns) AS mean, stddev_samp(qa_turns) AS std,
    CAST(min(qa_turns) AS DOUBLE) AS min, CAST(max(qa_turns) AS DOUBLE) AS max, quantile_cont(CAST(qa_turns AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST(qa_turns AS DOUBLE), 0.5) AS q2, quantile_cont(CAST(qa_turns AS DOUBLE), 0.75) AS q3 FROM pcl GROUP BY cluster)""")
          + """SELECT cluster, mean, std, min, max, CASE WHEN max > min THEN (q1 - min) / (max - min) ELSE 0.5 END AS q1_norm,
                 CASE WHEN max > min THEN (q2 - min) / (max - min) ELSE 0.5 END AS median_norm,
                 CASE WHEN max > min THEN (q3 - min) / (max - min) ELSE 0.5 END AS q3_norm FROM b""",
          floats=("mean", "std", "min", "max", "q1_norm", "median_norm", "q3_norm"))
def clu_turns_box(spark, sf):
    """AGG27: per-cluster qa_turns box statistics."""
    return pf.turns_box(_profiled(spark, sf, ["qa_turns"]))


_PZ_LONG = " UNION ALL ".join(f"SELECT cluster, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean FROM pcl GROUP BY cluster" for c in L.FEATURE_COLUMNS)


@register("clu_profile_z", O.with_(*_FEAT_IMP, f"lf AS ({_PZ_LONG})")
          + """SELECT cluster, feature, mean, (mean - avg(mean) OVER w) / CASE WHEN stddev_samp(mean) OVER w = 0 THEN 1e-8 ELSE stddev_samp(mean) OVER w END AS z
               FROM lf WINDOW w AS (PARTITION BY feature)""",
          floats=("mean", "z"))
def clu_profile_z(spark, sf):
    """AGG28: cluster feature means z-scored across clusters."""
    return pf.profile_z(_profiled(spark, sf), L.FEATURE_COLUMNS)


@register("clu_progress_hist", O.with_(*_FEAT_IMP,
                                       "lf AS (SELECT cluster, 'course_progress_ratio' AS feature, CAST(course_progress_ratio AS DOUBLE) AS value FROM pcl WHERE course_progress_ratio > 0)",
                                       "r0 AS (SELECT cluster, feature, min(value) AS lo0, max(value) AS hi0 FROM lf GROUP BY cluster, feature)",
                                       "r AS (SELECT cluster, feature, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0)",
                                       O.edges_cte("r", 20))
          + "SELECT lf.cluster, lf.feature, bin, count(*) AS count, min(e0) AS lo, min(e1) AS hi FROM lf JOIN edges e ON e.cluster IS NOT DISTINCT FROM lf.cluster AND e.feature = lf.feature AND value >= e0 AND (value < e1 OR bin = 19 AND value <= e1) GROUP BY lf.cluster, lf.feature, bin",
          floats=("lo", "hi"))
def clu_progress_hist(spark, sf):
    """AGG29 + FLT13: per-cluster 20-bin course-progress histogram."""
    return pf.progress_hist(_profiled(spark, sf, ["course_progress_ratio"]))


@register("clu_class_pivot", O.with_(*O.views("clustered"))
          + "SELECT class_id, " + ", ".join(f'CAST(count(*) FILTER (WHERE cluster = {i}) AS BIGINT) AS "{i}"' for i in range(5)) + " FROM clustered GROUP BY class_id")
def clu_class_pivot(spark, sf):
    """AGG30: class x cluster count pivot."""
    return pf.class_pivot(C.clustered(spark, sf), 5)


@register("clu_class_preview", O.with_(*O.views("clustered"))
          + "SELECT class_id, " + ", ".join(f'CAST(count(*) FILTER (WHERE cluster = {i}) AS BIGINT) AS "{i}"' for i in range(5))
          + ", CAST(row_number() OVER (ORDER BY class_id) AS INTEGER) AS position FROM clustered GROUP BY class_id ORDER BY class_id LIMIT 5")
def clu_class_preview(spark, sf):
    """SRT3: the first classes of the class x cluster counts, in order."""
    return pf.preview(pf.class_pivot(C.clustered(spark, sf), 5), ["class_id"])


def _loadings(spark, sf):
    return ml.pca_table(spark, ml.pca_fit(ml.standardize(_emb(spark, sf), E), E))


@register("ml_top_loadings")
def ml_top_loadings(spark, sf):
    """SRT4: rounded loadings of the first three components by feature."""
    return ml.top_loadings(_loadings(spark, sf))


@register("ml_top_ratios")
def ml_top_ratios(spark, sf):
    """SRT4: ratios of the first six components and their running sum."""
    return ml.top_ratios(_loadings(spark, sf))
