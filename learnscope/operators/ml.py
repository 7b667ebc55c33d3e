"""Clustering of session features: standardize, PCA, component selection,
K-Means sweep + elbow, final labels, agreement (ARI) and stability.

Data stays distributed: statistics are one-row aggregates, covariances are
summed per task as small matrices, PCA uses Spark ML's distributed covariance
(the driver sees only the p x p matrix), and projections and nearest-centroid
labels are matrix products on Arrow batches. K-Means is Lloyd's algorithm for
many models at once: one pass over the rows serves one iteration of every model
that has not converged, whatever their K and seed, and returns one row per model
and cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as L
from .common import attach_one_row

# ------------------------------------------------------------------ standardize / covariance


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), binary: Sequence[str] = ()) -> DataFrame:
    """ML1 (+ML2): z-score every column with the population std; zero-variance
    columns give 0 (no jitter); non-finite results -> 0. Columns listed in
    ``binary`` are passed through as doubles, unscaled; the default is none,
    as in the original (its binary list is always empty)."""
    scaled = [c for c in cols if c not in set(binary)]
    stats = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in scaled], *[F.stddev_pop(c).alias(f"__s_{c}") for c in scaled])
    j = attach_one_row(df.select(*keep, *cols), stats)
    out = []
    for c in cols:
        if c in set(binary):
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
            continue
        z = F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")).otherwise(F.lit(0.0))
        z = F.when(z.isNull() | F.isnan(z) | (F.abs(z) == F.lit(float("inf"))), F.lit(0.0)).otherwise(z)
        out.append(z.alias(c))
    return j.select(*keep, *out)


def jitter_constant(df: DataFrame, cols: Sequence[str], seed: int, scale: float = 1e-8) -> DataFrame:
    """AGG21 option: add N(0, scale) noise to zero-variance columns (seeded)."""
    var = df.agg(*[F.var_samp(c).alias(c) for c in cols]).first()
    out = df
    for c in cols:
        if var[c] is not None and var[c] == 0:
            out = out.withColumn(c, F.col(c) + F.randn(seed) * scale)
    return out


def _matrix(batch: pa.RecordBatch, cols: Sequence[str]) -> np.ndarray:
    """The columns of an Arrow batch as an n x p matrix (null: NaN)."""
    get = batch.schema.get_field_index
    return np.column_stack([batch.column(get(c)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols]) if cols else np.empty((batch.num_rows, 0))


def _append(df: DataFrame, cols: Sequence[str], compute, new: T.StructType) -> DataFrame:
    """``df`` and the columns ``new`` that ``compute`` makes of each batch's
    matrix of ``cols``."""
    own = [f for f in df.schema.fields if f.name not in set(new.names)]
    names = [f.name for f in own]
    cols = list(cols)

    def run(batches):
        for b in batches:
            yield pa.record_batch([*(b.column(b.schema.get_field_index(n)) for n in names), *compute(_matrix(b, cols))], names=[*names, *new.names])

    return df.select(*dict.fromkeys([*names, *cols])).mapInArrow(run, T.StructType([*own, *new.fields]))


def covariance(z: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ML3: population covariance of every column pair, long form (feature_i,
    feature_j, cov). Rows are centred by the columns' means first, as products of
    large values would cancel; each task sums one p x p matrix."""
    cols = list(cols)
    means = np.array([m or 0.0 for m in z.agg(*[F.avg(c) for c in cols]).first()], float)

    def run(batches):
        n, s, g = 0, np.zeros(len(cols)), np.zeros((len(cols), len(cols)))
        for b in batches:
            x = _matrix(b, cols) - means
            n, s, g = n + len(x), s + x.sum(axis=0), g + x.T @ x
        if n:
            i, j = (a.ravel() for a in np.indices(g.shape))
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(np.full(len(i), n)), pa.array(s[i]), pa.array(s[j]), pa.array(g.ravel())],
                                  names=["i", "j", "n", "si", "sj", "sij"])

    parts = z.select(*cols).mapInArrow(run, "i int, j int, n long, si double, sj double, sij double")
    t = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sij")])
    names = F.array(*[F.lit(c) for c in cols])
    return t.select(F.element_at(names, F.col("i") + 1).alias("feature_i"), F.element_at(names, F.col("j") + 1).alias("feature_j"),
                    (F.col("sij") / F.col("n") - (F.col("si") / F.col("n")) * (F.col("sj") / F.col("n"))).alias("cov"))


# ------------------------------------------------------------------ PCA


@dataclass
class PcaResult:
    columns: list[str]
    loadings: list[list[float]]  # loadings[j][i]: component j, feature i
    ratios: list[float]


def pca_fit(z: DataFrame, cols: Sequence[str]) -> PcaResult:
    """ML4-5: full PCA of standardized columns with Spark ML. Signs follow
    the rule 'largest-magnitude loading is positive'."""
    from pyspark.ml.feature import PCA, VectorAssembler

    vec = VectorAssembler(inputCols=list(cols), outputCol="__v").transform(z.select(*cols))
    model = PCA(k=len(cols), inputCol="__v", outputCol="__p").fit(vec)
    pc = model.pc.toArray()  # p x k
    loadings = []
    for j in range(pc.shape[1]):
        comp = [float(x) for x in pc[:, j]]
        big = max(range(len(comp)), key=lambda i: abs(comp[i]))
        sign = 1.0 if comp[big] >= 0 else -1.0
        loadings.append([sign * x for x in comp])
    return PcaResult(list(cols), loadings, [float(x) for x in model.explainedVariance.toArray()])


def pca_scores(z: DataFrame, res: PcaResult, keep: Sequence[str] = (), m: int | None = None, prefix: str = "pc") -> DataFrame:
    """Scores ``pc1..pcm``: the inputs times the loadings, batch by batch."""
    m = m or len(res.loadings)
    w = np.array(res.loadings[:m]).T
    new = T.StructType([T.StructField(f"{prefix}{j + 1}", T.DoubleType()) for j in range(m)])
    out = _append(z, res.columns, lambda x: [pa.array(c) for c in np.ascontiguousarray((x @ w).T)], new)
    return out.select(*keep, *new.names)


def top_loadings(table: DataFrame, n_components: int = 3, digits: int = 3) -> DataFrame:
    """SRT4: loadings of the first components, rounded, one column per
    component (feature x PC1..PCn)."""
    t = table.filter(F.col("pc") <= n_components).withColumn("loading", F.round("loading", digits))
    return t.groupBy("feature").pivot("pc", list(range(1, n_components + 1))).agg(F.first("loading")) \
        .select("feature", *[F.col(str(i)).alias(f"PC{i}") for i in range(1, n_components + 1)])


def top_ratios(table: DataFrame, n: int = 6) -> DataFrame:
    """SRT4: variance ratios of the first components, with their running sum."""
    return table.filter(F.col("pc") <= n).select("pc", "ratio", "cumulative").distinct()


def pca_table(spark, res: PcaResult) -> DataFrame:
    """Long loadings table (pc, feature, loading, ratio, cumulative)."""
    rows, cum = [], 0.0
    total = sum(res.ratios) or 1.0
    for j, comp in enumerate(res.loadings):
        cum += res.ratios[j] / total
        for i, c in enumerate(res.columns):
            rows.append((j + 1, c, comp[i], res.ratios[j], cum))
    schema = "pc int, feature string, loading double, ratio double, cumulative double"
    return spark.createDataFrame(rows, schema)


def select_components(ratios: DataFrame, threshold: float = L.VARIANCE_THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    """WIN6 + ML6: first component count whose cumulative (renormalized)
    ratio reaches ``threshold``; 1 when never reached (as the original's
    argmax over all-False). Input: (by..., pc, ratio)."""
    by = list(by)
    w_all = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    w_cum = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("pc").rowsBetween(Window.unboundedPreceding, 0)
    r = ratios.withColumn("__r", F.col("ratio") / F.sum("ratio").over(w_all)).withColumn("cumulative", F.sum("__r").over(w_cum))
    g = r.groupBy(*by).agg(
        F.min(F.when(F.col("cumulative") >= threshold, F.col("pc"))).alias("__n"),
        F.max_by("cumulative", "pc").alias("__last"),
        F.min_by("cumulative", F.when(F.col("cumulative") >= threshold, F.col("pc"))).alias("__at"),
    )
    return g.select(
        *by, F.lit(float(threshold)).alias("threshold"),
        F.coalesce(F.col("__n"), F.lit(1)).cast("int").alias("n_components"),
        F.when(F.col("__n").isNotNull(), F.col("__at")).otherwise(F.col("__last")).alias("variance"),
    )


# ------------------------------------------------------------------ K-Means


CHUNK = 1 << 21  # distances held at a time
NEAR_CHUNK = 1 << 16  # of them, where they are read several times
FEW_CENTERS = 32  # of a model whose sums are taken as products
ROWS_PER_TASK = 50_000  # in the passes of a fit, at least
CANDIDATES = 500  # drawn from all rows in each round before a fit
ROUNDS = 4
FEW_PAIRS = 12  # of labelings, counted pair by pair


@dataclass
class Fit:
    k: int
    seed: int
    centers: np.ndarray  # k x p
    cost: float  # sum of squared distances to the nearest center, over all rows


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest center (lowest number on ties) and squared distance per row."""
    label, best = np.zeros(len(x), np.int64), np.zeros(len(x))
    step = max(1, CHUNK // max(1, centers.size))
    for i in range(0, len(x), step):
        d = ((x[i: i + step, None, :] - centers[None]) ** 2).sum(axis=2)
        label[i: i + step] = d.argmin(axis=1)
        best[i: i + step] = d.min(axis=1)
    return label, best


def candidates(df: DataFrame, cols: Sequence[str], seed: int = L.RANDOM_STATE) -> tuple[np.ndarray, np.ndarray]:
    """Points that starting centers are chosen from, and how many rows each stands
    for. Every round draws ``CANDIDATES`` rows from all rows, without replacement,
    with chances in proportion to the squared distance from the points so far (the
    first round: all alike), so a small group far from the rest is met however few
    its rows are. A draw keeps the largest of seeded keys ``log(u) / d2``; each task
    sends its largest only. Rows with a missing coordinate are not drawn."""
    cols, names = list(cols), [f"x{j}" for j in range(len(cols))]
    schema = "key double" + "".join(f", {c} double" for c in names)
    points = np.empty((0, len(cols)))
    for i in range(ROUNDS):
        shared = df.sparkSession.sparkContext.broadcast(points)

        def draw(batches, shared=shared):
            centers = shared.value
            for b in batches:
                x, u = _matrix(b, cols), b.column(len(cols)).to_numpy()
                d = _nearest_squares(x, centers) if len(centers) else np.ones(len(x))
                some = np.flatnonzero((d > 0) & ~np.isnan(x).any(axis=1))
                key = np.log(np.maximum(u[some], 1e-300)) / d[some]
                some, key = (a[np.argsort(-key, kind="stable")[:CANDIDATES]] for a in (some, key))
                yield pa.record_batch([pa.array(key), *(pa.array(x[some, j]) for j in range(len(cols)))], names=["key", *names])

        found = df.select(*cols, F.rand(seed + i).alias("__u")).mapInArrow(draw, schema).orderBy(F.desc("key"), *names).limit(CANDIDATES)
        new = np.array([tuple(r)[1:] for r in found.collect()], float).reshape(-1, len(cols))
        points = np.unique(np.concatenate([points, new]), axis=0)
        if not len(new):
            break
    if not len(points):
        raise ValueError("no rows to cluster")
    ((n, _, _),) = lloyd_pass(df, cols, [points], cost=False)
    return points, n


def _nearest_squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its nearest center; exactly 0 for a row
    that is one."""
    out, cc = np.empty(len(x)), (centers ** 2).sum(axis=1)
    step = max(1, CHUNK // len(centers))
    for i in range(0, len(x), step):
        part = x[i: i + step]
        label = (cc - 2 * (part @ centers.T)).argmin(axis=1)
        out[i: i + step] = ((part - centers[label]) ** 2).sum(axis=1)
    return out


def _starts(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """K-means++ starting centers from weighted points, best of a few candidates
    at each step."""
    rng = np.random.default_rng(seed)
    weights = np.maximum(weights, 1e-9)  # a point may be nobody's nearest in a tie
    centers = [points[rng.choice(len(points), p=weights / weights.sum())]]
    d = ((points - centers[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        chance = d * weights
        total = chance.sum()
        pick = rng.choice(len(points), 2 + int(np.log(k)), p=chance / total if total > 0 else None)
        options = [np.minimum(d, ((points - points[i]) ** 2).sum(axis=1)) for i in pick]
        best = int(np.argmin([(o * weights).sum() for o in options]))
        centers.append(points[pick[best]])
        d = options[best]
    return np.array(centers)


PACKED = "__x"


def packed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The coordinates as one column, the rows of a batch in one value (their doubles,
    row by row; null: NaN): a pass moves bytes, and its plan does not grow with them."""
    if df.columns == [PACKED]:
        return df
    cols = list(cols)

    def run(batches):
        for b in batches:
            yield pa.record_batch([pa.array([_matrix(b, cols).tobytes()], pa.binary())], names=[PACKED])

    return df.select(*cols).mapInArrow(run, f"{PACKED} binary")


def _sums_by_label(x: np.ndarray, every: np.ndarray, cost: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, squared distances (0 without ``cost``) and sums of the clusters of
    models x k centers: every row's label is looked up, and counted."""
    m, k, p = every.shape
    flat_centers = every.reshape(m * k, p)
    cc, at, size = (flat_centers ** 2).sum(axis=1), np.arange(m) * k, m * k
    n, e, s = np.zeros(size), np.zeros(size), np.zeros((size, p))
    step = max(1, CHUNK // size)
    for i in range(0, len(x), step):
        part = x[i: i + step]
        label = (cc - 2 * (part @ flat_centers.T)).reshape(len(part), m, k).argmin(axis=2) + at
        flat = label.ravel()
        n += np.bincount(flat, minlength=size)
        if cost:
            e += np.bincount(flat, ((part[:, None, :] - flat_centers[label]) ** 2).sum(axis=2).ravel(), size)
        s += np.column_stack([np.bincount(flat, np.repeat(part[:, j], m), size) for j in range(p)])
    return n.reshape(m, k), e.reshape(m, k), s.reshape(m, k, p)


def _sums_by_product(x: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_sums_by_label` without cost, for finite rows: distances are laid out
    center by center, a row's nearest center is where the least of them stands (the
    first one on ties), and counts and sums are one product of these places and the rows."""
    m, k, p = every.shape
    by_center = every.transpose(1, 0, 2).reshape(k * m, p)
    w = np.column_stack([-2 * by_center, (by_center ** 2).sum(axis=1)])
    x1 = np.column_stack([x, np.ones(len(x))])
    total = np.zeros((k * m, p + 1))
    step = max(32, NEAR_CHUNK // (k * m))
    for i in range(0, len(x), step):
        part = x1[i: i + step]
        d = (w @ part.T).reshape(k, m * len(part))
        least = d.min(axis=0)
        hit = d == least
        if np.count_nonzero(hit) != hit.shape[1]:
            hit |= np.isnan(d)  # of centers out of range; argmin takes them first, too
            hit[1:] &= ~np.logical_or.accumulate(hit, axis=0)[:-1]
        total += hit.reshape(k * m, -1).astype(float) @ part
    total = total.reshape(k, m, p + 1).transpose(1, 0, 2)
    return total[..., p], np.zeros((m, k)), total[..., :p]


def lloyd_pass(df: DataFrame, cols: Sequence[str], centers: Sequence[np.ndarray], cost: bool = True) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One pass for many models: per model the rows of each cluster (k), their
    sums (k x p) and, with ``cost``, squared distances (k). Each task returns these
    numbers as rows (place, number), and so does the job, whatever the data. ``df``
    has the columns, or is :func:`packed`."""
    p = len(cols)
    groups: dict[int, list[int]] = {}
    for m, c in enumerate(centers):
        groups.setdefault(len(c), []).append(m)
    shared = df.sparkSession.sparkContext.broadcast([np.asarray(c) for c in centers])

    def run(batches):
        cs = shared.value
        n = [np.zeros(len(c)) for c in cs]
        s = [np.zeros((len(c), p)) for c in cs]
        e = [np.zeros(len(c)) for c in cs]
        for full in (np.frombuffer(v.as_buffer(), float).reshape(-1, p) for b in batches for v in b.column(0)):
            odd = ~np.isfinite(full).all(axis=1)
            for k, models in groups.items():
                every = np.stack([cs[m] for m in models])  # models x k x p
                parts = [_sums_by_label(full, every, cost)] if cost or k > FEW_CENTERS else [_sums_by_product(full[~odd], every), _sums_by_label(full[odd], every, False)]
                for nn, ee, ss in parts:
                    for q, m in enumerate(models):
                        n[m] += nn[q]
                        e[m] += ee[q]
                        s[m] += ss[q]
        every = np.column_stack([np.concatenate(n), np.concatenate(e), np.concatenate(s)]).ravel()
        at = np.flatnonzero(every)
        yield pa.record_batch([pa.array(at), pa.array(every[at])], names=["at", "v"])

    sums = packed(df, cols).mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()  # models * k * (p + 2)
    k = [len(c) for c in centers]
    every = np.zeros(sum(k) * (p + 2))
    every[sums.column("at").to_numpy()] = sums.column("v").to_numpy()
    models = np.split(every.reshape(-1, p + 2), np.cumsum(k)[:-1])
    return [(np.rint(m[:, 0]).astype(np.int64), m[:, 2:], m[:, 1]) for m in models]


def _moved(centers: np.ndarray, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Mean of each cluster's rows; a cluster without rows keeps its center."""
    return np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centers)


def lloyd(df: DataFrame, cols: Sequence[str], starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """Final centers and cost of every model. A model is done when the squared
    moves of its centers add up to no more than ``tol`` times the mean variance
    of the columns; passes serve the models still moving."""
    centers = [np.asarray(c, float) for c in starts]
    moving = list(range(len(centers)))
    var = df.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    enough = tol * float(np.mean([v or 0.0 for v in var]))
    df = packed(df, cols).persist()
    for _ in range(max_iter):
        if not moving:
            break
        still = []
        for m, (n, s, _) in zip(moving, lloyd_pass(df, cols, [centers[m] for m in moving], cost=False)):
            new = _moved(centers[m], n, s)
            if ((new - centers[m]) ** 2).sum() > enough:
                still.append(m)
            centers[m] = new
        moving = still
    last = lloyd_pass(df, cols, centers)
    df.unpersist()
    return [(c, float(e.sum())) for c, (_, _, e) in zip(centers, last)]


def lloyd_steps(df: DataFrame, cols: Sequence[str], start: np.ndarray, steps: int) -> DataFrame:
    """The first iterations from given centers, as rows (step, cluster, n, sse):
    step i has the clusters and distances under the centers before update i."""
    rows, c = [], np.asarray(start, float)
    for i in range(steps):
        ((n, s, e),) = lloyd_pass(df, cols, [c])
        rows += [(i, k, int(n[k]), float(e[k])) for k in range(len(c))]
        c = _moved(c, n, s)
    return df.sparkSession.createDataFrame(rows, "step int, cluster int, n long, sse double")


def fit_many(df: DataFrame, cols: Sequence[str], specs: Sequence[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """One K-Means fit per (k, seed) of ``specs``, all in the same passes over all
    rows; starting centers come from :func:`candidates`."""
    rows = df.select(*cols)
    rows = rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK)))  # many short passes: no tasks of a few rows
    points, weights = candidates(rows, cols)
    starts = [_starts(points, weights, k, seed) for k, seed in specs]
    return [Fit(k, seed, c, cost) for (k, seed), (c, cost) in zip(specs, lloyd(rows, cols, starts, max_iter, tol))]


def kmeans_best(df: DataFrame, cols: Sequence[str], k: int, n_init: int = L.N_INIT, seed: int = L.RANDOM_STATE, max_iter: int = 300) -> Fit:
    """ML7/ML10: best (lowest inertia) of ``n_init`` fits with seeds seed,
    seed+1, ..."""
    return min(fit_many(df, cols, [(k, seed + i) for i in range(n_init)], max_iter), key=lambda f: f.cost)


def k_sweep(df: DataFrame, cols: Sequence[str], n_rows: int, max_k: int = L.MAX_K, n_init: int = L.N_INIT, seed: int = L.RANDOM_STATE, min_k: int = 2) -> DataFrame:
    """ML7: inertia of the best of ``n_init`` fits for K = min_k..min(max_k, n-1)."""
    ks = list(range(min_k, min(max_k + 1, n_rows)))
    if not ks:
        raise ValueError(f"need at least 3 rows to sweep K, got {n_rows}")
    fits = fit_many(df, cols, [(k, seed + i) for k in ks for i in range(n_init)])
    rows = [(k, min(f.cost for f in fits if f.k == k)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def elbow(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """WIN7: slope-change elbow. slopes = |dInertia/dK|; the K whose
    neighbouring slopes differ most is chosen (lowest K on ties); fewer than 3
    points -> the first K. Input: (by..., k, inertia), one row per K."""
    by = list(by)
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("k")
    s = sweep.withColumn("__pk", F.lag("k").over(w)).withColumn("__pi", F.lag("inertia").over(w)) \
        .withColumn("__nk", F.lead("k").over(w)).withColumn("__ni", F.lead("inertia").over(w))
    s = s.withColumn("__left", F.abs((F.col("inertia") - F.col("__pi")) / (F.col("k") - F.col("__pk")))) \
        .withColumn("__right", F.abs((F.col("__ni") - F.col("inertia")) / (F.col("__nk") - F.col("k")))) \
        .withColumn("change", F.abs(F.col("__right") - F.col("__left")))
    g = s.groupBy(*by).agg(
        F.max_by(F.struct("k", "change"), F.struct(F.col("change"), -F.col("k"))).alias("__best"),
        F.min("k").alias("__k0"),
    )
    return g.select(*by, F.coalesce(F.col("__best.k"), F.col("__k0")).alias("k"), F.col("__best.change").alias("change"))


def assign(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """ML9: nearest centroid (squared Euclidean; lowest id on ties) and
    ``dist2``; null for rows with a missing coordinate."""
    c = np.asarray(centers, float)

    def compute(x):
        label, d = _nearest(x, c)
        bad = np.isnan(x).any(axis=1)
        return [pa.array(label.astype(np.int32), mask=bad), pa.array(d, mask=bad)]

    return _append(df, cols, compute, T.StructType([T.StructField(out, T.IntegerType()), T.StructField("dist2", T.DoubleType())]))


def assign_many(df: DataFrame, cols: Sequence[str], centers: Sequence[np.ndarray], names: Sequence[str]) -> DataFrame:
    """The labels of many models, one column each, in one pass."""
    cs = [np.asarray(c, float) for c in centers]
    new = T.StructType([T.StructField(n, T.IntegerType()) for n in names])
    return _append(df, cols, lambda x: [pa.array(_nearest(x, c)[0].astype(np.int32)) for c in cs], new)


def inertia(df: DataFrame, cols: Sequence[str], label: str, centers: DataFrame) -> DataFrame:
    """ML8: per-label n and sum of squared distances to the label's center
    (``centers``: label + cols). The center table has one row per label."""
    c = centers.select(label, *[F.col(x).alias(f"__c_{x}") for x in cols])
    j = df.join(F.broadcast(c), on=label, how="inner")
    e = F.lit(0.0)
    for x in cols:
        d = F.col(x) - F.col(f"__c_{x}")
        e = e + d * d
    return j.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(e).alias("sse"))


def relabel_by_size(labels: DataFrame, centers: Sequence[Sequence[float]], col: str = "cluster") -> tuple[DataFrame, list[list[float]]]:
    """Make K-Means ids reproducible: order clusters by size desc, then by the
    first coordinate of the center."""
    sizes = {r[col]: r["n"] for r in labels.groupBy(col).agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(centers)), key=lambda i: (-sizes.get(i, 0), centers[i][0]))
    remap = {old: new for new, old in enumerate(order)}
    m = F.create_map(*[x for o, n in remap.items() for x in (F.lit(o), F.lit(n))])
    return labels.withColumn(col, m[F.col(col)].cast("int")), [list(centers[o]) for o in order]


def cluster(df: DataFrame, cols: Sequence[str], k: int, n_init: int = L.N_INIT, seed: int = L.RANDOM_STATE, out: str = "cluster"):
    """ML10: final K-Means labels (best of ``n_init``), ids relabelled by size.
    Returns (labelled DataFrame, centers)."""
    centers = kmeans_best(df, cols, k, n_init, seed).centers.tolist()
    lab = assign(df, cols, centers, out).drop("dist2")
    return relabel_by_size(lab, centers, out)


# ------------------------------------------------------------------ agreement


def _ari_from_counts(g: DataFrame, by: Sequence[str]) -> DataFrame:
    """sklearn's pair-confusion ARI from contingency rows (by..., a, b, nij)."""
    by = list(by)

    def squares(c):  # counts reach 1e9 and more: their squares do not fit a long
        w = F.col(c).cast("decimal(19,0)")
        return F.sum((w * w).cast("decimal(38,0)"))

    ss = g.groupBy(*by).agg(squares("nij").alias("ss"), F.sum("nij").alias("n"))
    sa = g.groupBy(*by, "a").agg(F.sum("nij").alias("x")).groupBy(*by).agg(squares("x").alias("sa"))
    sb = g.groupBy(*by, "b").agg(F.sum("nij").alias("x")).groupBy(*by).agg(squares("x").alias("sb"))
    t = ss.join(sa, on=by, how="inner").join(sb, on=by, how="inner") if by else attach_one_row(attach_one_row(ss, sa), sb)
    tp = F.col("ss").cast("double") - F.col("n")
    fp = F.col("sb").cast("double") - F.col("ss")
    fn = F.col("sa").cast("double") - F.col("ss")
    tn = F.col("n").cast("double") * F.col("n") - fp - fn - F.col("ss")
    ari = F.when((fn == 0) & (fp == 0), F.lit(1.0)).otherwise(2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)))
    return t.select(*by, ari.alias("ari"))


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """ML11: adjusted Rand index of two label columns (one row)."""
    g = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("nij"))
    return _ari_from_counts(g, [])


def ari_pairwise(df: DataFrame, label_cols: Sequence[str]) -> DataFrame:
    """JOIN6 + ML11: ARI of every pair (i < j) of labelings. Up to ``FEW_PAIRS``
    pairs are counted as rows (pair, a, b), summed in the task first. With more
    labelings each task counts the co-occurrence of all labels as one matrix
    product of its one-hot rows, and returns one row per pair of labels of two
    labelings. Either way the amount shuffled depends on the numbers of labels, not
    on the rows or their variety. A null label is a label of its own."""
    n = len(label_cols)
    labels = df.select(*[F.col(c).cast("int").alias(f"l{i}") for i, c in enumerate(label_cols)])
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    if 0 < len(pairs) <= FEW_PAIRS:
        each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"l{i}").alias("a"), F.col(f"l{j}").alias("b")) for i, j in pairs])
        g = labels.select(F.explode(each).alias("p")).select("p.*").groupBy("i", "j", "a", "b").agg(F.count(F.lit(1)).alias("nij"))
        return _ari_from_counts(g, ["i", "j"])
    null = np.iinfo(np.int32).min

    def run(batches):
        total: dict[tuple, int] = {}
        for b in batches:
            codes, names, at = [], [], 0
            for i in range(n):
                u, inverse = np.unique(b.column(i).fill_null(int(null)).to_numpy(zero_copy_only=False), return_inverse=True)
                codes.append(inverse + at)
                names += [(i, int(v)) for v in u]
                at += len(u)
            codes = np.array(codes)
            g = np.zeros((at, at))
            for k in range(0, b.num_rows, 4096):
                c = codes[:, k: k + 4096]
                x = np.zeros((c.shape[1], at), np.float32)
                x[np.arange(c.shape[1])[None, :], c] = 1
                g += x.T @ x
            for p, q in zip(*np.nonzero(np.triu(g, 1))):
                if names[p][0] != names[q][0]:
                    key = (*names[p], *names[q])
                    total[key] = total.get(key, 0) + int(g[p, q])
        cols = list(zip(*total)) if total else [[], [], [], []]
        yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(list(total.values()), pa.int64())],
                              names=["i", "j", "a", "b", "nij"])

    g = labels.mapInArrow(run, "i int, j int, a int, b int, nij long").groupBy("i", "j", "a", "b").agg(F.sum("nij").alias("nij"))
    return _ari_from_counts(g, ["i", "j"])


def ari_summary(pairwise: DataFrame) -> DataFrame:
    """AGG35 + SCL19: mean, population std and min ARI, with the stability
    label."""
    g = pairwise.agg(F.count(F.lit(1)).alias("n_pairs"), F.avg("ari").alias("mean_ari"), F.stddev_pop("ari").alias("std_ari"),
                     F.min("ari").alias("min_ari"))
    label = F.when(F.col("mean_ari") > L.STABILITY_HIGH, "Highly Stable").when(F.col("mean_ari") > L.STABILITY_MODERATE, "Moderately Stable").otherwise("Unstable")
    return g.withColumn("stability", label)


def stability(vec_cols_df: DataFrame, cols: Sequence[str], k: int, n_iterations: int = L.STABILITY_ITERATIONS,
              n_init: int = L.N_INIT, seed: int = L.RANDOM_STATE) -> tuple[DataFrame, DataFrame]:
    """ML12: refit K-Means ``n_iterations`` times (seeds seed..), label every
    row with each model, then all pairwise ARIs.
    Returns (summary row with iterations, pairwise scores)."""
    fits = fit_many(vec_cols_df, cols, [(k, (seed + it) * 1000 + i) for it in range(n_iterations) for i in range(n_init)])
    best = [min(fits[it * n_init:(it + 1) * n_init], key=lambda f: f.cost) for it in range(n_iterations)]
    names = [f"__l{it}" for it in range(n_iterations)]
    lab = assign_many(vec_cols_df.select(*cols), cols, [f.centers for f in best], names)
    pw = ari_pairwise(lab, names)
    summary = ari_summary(pw).withColumn("iterations", F.lit(n_iterations))
    return summary, pw
