"""Column statistics and missing-value handling over wide feature tables.

Per-feature statistics unpivot the wide table to (feature, value) and run one
``groupBy(feature)`` — partial aggregation, one shuffle, no per-column jobs.
Exact medians and quartiles come from :func:`exact_quantiles`, which never
gathers a group's values into one task (a hot class or feature stays
distributed); ``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_one_row, is_finite, join_groups


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """FLT10: numeric columns of ``df`` (declared keys excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def select_features(df: DataFrame, preferred: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """FLT9: the preferred feature columns that exist, in preferred order."""
    return df.select(*keep, *[c for c in preferred if c in df.columns])


def nonfinite_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT7: NaN and +-Inf -> null (needed before any median: Spark orders NaN
    above +Inf and keeps both)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(is_finite(c), F.col(c).cast("double")))
    return out


def long_form(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Unpivot to (keys..., feature, value double)."""
    casted = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(keys), list(cols), "feature", "value")


QUANTILE_ACCURACY = 10000


def exact_quantiles(df: DataFrame, value: str, groups: Sequence[str] = (), probs: Sequence[float] = (0.5,),
                    accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation (the ``percentile`` /
    pandas definition) per group, without ever holding a group's values in
    one task: (1) a mergeable ``percentile_approx`` sketch brackets each
    target rank with [lo, hi]; (2) exact counts below / inside the bracket
    verify it (a failed bracket falls back to the whole range); (3) only the
    distinct values inside the bracket (about 4n/accuracy rows plus ties) are
    ranked. Returns (groups..., p, value); null/NaN values are ignored, and a
    null group key is a group of its own.
    A group holding a third of the data costs two partial aggregates over it
    plus a window over a small slice."""
    groups = list(groups)
    eps = 1.0 / accuracy
    d = df.select(*groups, F.col(value).cast("double").alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x"))
    lo_p = [max(0.0, p - 2 * eps) for p in probs]
    hi_p = [min(1.0, p + 2 * eps) for p in probs]
    sk = d.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__x", lo_p, accuracy).alias("__lo"),
        F.percentile_approx("__x", hi_p, accuracy).alias("__hi"),
    )
    per_p = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.lit(i).alias("i")) for i, p in enumerate(probs)]))
    b = sk.select(*groups, "__n", "__lo", "__hi", per_p.alias("__pp")).select(
        *groups, "__n", F.col("__pp.p").alias("p"),
        F.element_at("__lo", F.col("__pp.i") + 1).alias("__qlo"), F.element_at("__hi", F.col("__pp.i") + 1).alias("__qhi"))
    pos = (F.col("__n") - 1) * F.col("p")
    b = b.withColumn("__klo", (F.floor(pos) + 1).cast("long")).withColumn("__khi", (F.ceil(pos) + 1).cast("long")) \
         .withColumn("__frac", pos - F.floor(pos))
    # exact counts below / inside each bracket (one pass, partial aggregation)
    # bounds: one row per (group, p); AQE broadcasts it at runtime when small
    bounds = b.select(*groups, "p", "__qlo", "__qhi")
    j = join_groups(d, bounds, groups)
    cnt = j.groupBy(*groups, "p").agg(
        F.count_if(F.col("__x") < F.col("__qlo")).alias("__below"),
        F.count_if((F.col("__x") >= F.col("__qlo")) & (F.col("__x") <= F.col("__qhi"))).alias("__in"))
    b = join_groups(b, cnt, [*groups, "p"])
    ok = (F.col("__below") < F.col("__klo")) & (F.col("__below") + F.col("__in") >= F.col("__khi"))
    b = b.select(*groups, "p", "__klo", "__khi", "__frac",
                 F.when(ok, F.col("__qlo")).otherwise(F.lit(float("-inf"))).alias("__qlo"),
                 F.when(ok, F.col("__qhi")).otherwise(F.lit(float("inf"))).alias("__qhi"),
                 F.when(ok, F.col("__below")).otherwise(F.lit(0)).alias("__below"))
    j = join_groups(d, b.select(*groups, "p", "__qlo", "__qhi"), groups)
    inside = j.filter((F.col("__x") >= F.col("__qlo")) & (F.col("__x") <= F.col("__qhi")))
    vals = inside.groupBy(*groups, "p", "__x").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*groups, "p").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vals = vals.withColumn("__cum", F.sum("__c").over(w)).withColumn("__start", F.col("__cum") - F.col("__c") + 1)
    v = join_groups(vals, b, [*groups, "p"])
    rlo = F.col("__klo") - F.col("__below")
    rhi = F.col("__khi") - F.col("__below")
    hit_lo = (F.col("__start") <= rlo) & (F.col("__cum") >= rlo)
    hit_hi = (F.col("__start") <= rhi) & (F.col("__cum") >= rhi)
    r = v.groupBy(*groups, "p").agg(
        F.max(F.when(hit_lo, F.col("__x"))).alias("__vlo"), F.max(F.when(hit_hi, F.col("__x"))).alias("__vhi"),
        F.first("__frac").alias("__frac"))
    return r.select(*groups, "p", (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac")).alias("value"))


def _medians_long(lf: DataFrame, groups: Sequence[str], approx: bool, name: str = "median") -> DataFrame:
    if approx:
        return lf.groupBy(*groups).agg(F.percentile_approx("value", 0.5, 100000).alias(name))
    return exact_quantiles(lf, "value", groups, [0.5]).select(*groups, F.col("value").alias(name))


def feature_stats(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """AGG12 (+SNK6): min, max, mean, median, sample variance per feature;
    nulls/NaN dropped; features with no data are omitted. ``cols=None``
    auto-detects numeric columns (FLT10) minus ``exclude`` (declared keys)."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    lf = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    g = lf.groupBy("feature").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"),
    )
    return g.join(_medians_long(lf, ["feature"], approx), on="feature", how="left").select(
        "feature", "min", "max", "mean", "median", "variance")


def binary_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG13: value counts of features whose values are a subset of {0, 1}."""
    lf = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    per_value = lf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    binary = per_value.groupBy("feature").agg(
        F.count(F.lit(1)).alias("__nd"), F.max((~F.col("value").isin(0.0, 1.0)).cast("int")).alias("__other")
    ).filter((F.col("__nd") <= 2) & (F.col("__other") == 0)).select("feature")
    return per_value.join(binary, on="feature", how="left_semi").select(
        "feature", F.col("value").cast("int").alias("value"), "count")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """AGG14 / AGG29: equal-width histogram per feature (and per ``by``
    group): a value belongs to the bin whose edges hold it, lower edge included,
    last bin closed; constant data bins over [v-0.5, v+0.5].
    Returns (by..., feature, bin, lo, hi, count) for non-empty bins."""
    lf = long_form(df, cols, by).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    rng = lf.groupBy(*by, "feature").agg(F.min("value").alias("__lo0"), F.max("value").alias("__hi0"))
    eq = F.col("__lo0") == F.col("__hi0")
    rng = rng.select(*by, "feature",
                     F.when(eq, F.col("__lo0") - 0.5).otherwise(F.col("__lo0")).alias("__lo"),
                     F.when(eq, F.col("__hi0") + 0.5).otherwise(F.col("__hi0")).alias("__hi"))
    j = join_groups(lf, rng, [*by, "feature"])
    v, lo, hi = F.col("value"), F.col("__lo"), F.col("__hi")

    def edge(i):  # equally spaced from lo, the last one exactly hi
        return F.when(i == bins, hi).otherwise(lo + i * ((hi - lo) / F.lit(float(bins))))

    guess = F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    j = j.withColumn("bin", guess)
    i = F.col("bin")
    # the computed index can be one off where a value meets an edge
    j = j.withColumn("bin", F.when(v < edge(i), i - 1).when((v >= edge(i + 1)) & (i < bins - 1), i + 1).otherwise(i))
    return j.groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("count"), F.first(edge(i)).alias("lo"), F.first(edge(i + 1)).alias("hi"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG24: count, mean, std (sample), min, 25/50/75% (linear
    interpolation, exact), max per feature."""
    lf = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    g = lf.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    q = exact_quantiles(lf, "value", ["feature"], [0.25, 0.5, 0.75])
    qw = q.groupBy("feature").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.select("feature", *[F.col(f"`{p}`").alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return g.join(qw, on="feature", how="left").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def nonfinite_audit(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """AGG22: per feature: +-Inf count, NaN count, null count, smallest key of
    a non-finite row, and min/max/mean/std (sample) of the finite values."""
    casted = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    lf = casted.unpivot([key], list(cols), "feature", "value")
    v = F.col("value")
    inf = v.isNotNull() & (F.abs(v) == F.lit(float("inf")))
    nan = v.isNotNull() & F.isnan(v)
    fin = F.when(is_finite(v), v)
    return lf.groupBy("feature").agg(
        F.count_if(inf).alias("inf_count"), F.count_if(nan).alias("nan_count"), F.count_if(v.isNull()).alias("null_count"),
        F.min(F.when(inf | nan, F.col(key))).alias("first_nonfinite_key"),
        F.min(fin).alias("finite_min"), F.max(fin).alias("finite_max"), F.avg(fin).alias("finite_mean"), F.stddev_samp(fin).alias("finite_std"),
    )


def nan_profile(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """AGG23: per (feature, group): size, missing (null or NaN) count,
    mean ignoring missing, and status all_nan / partial_nan / complete."""
    lf = long_form(df, cols, [group])
    miss = F.col("value").isNull() | F.isnan("value")
    g = lf.groupBy("feature", group).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(miss).alias("n_missing"), F.avg(F.when(~miss, F.col("value"))).alias("nan_mean"))
    status = F.when(F.col("n_missing") == F.col("n"), "all_nan").when(F.col("n_missing") > 0, "partial_nan").otherwise("complete")
    return g.withColumn("status", status)


def class_median_fill(df: DataFrame, cols: Sequence[str], class_col: str = "class_id", drop_null_class: bool = False, approx: bool = False) -> DataFrame:
    """AGG19: +-Inf/NaN -> missing; fill with the class median, else the
    global median, else 0. Medians are computed once per (class, column)
    and joined back (no per-class window, no per-class value gathering).
    Rows without a class are a group like any other;
    ``drop_null_class=True`` drops them, as pandas ``groupby`` does."""
    d = nonfinite_to_null(df, cols)
    if drop_null_class:
        d = d.filter(F.col(class_col).isNotNull())
    lf = long_form(d, cols, [class_col])
    cm = _medians_long(lf, [class_col, "feature"], approx).groupBy(class_col).pivot("feature", list(cols)).agg(F.first("median"))
    cm = cm.select(F.col(class_col).alias("__cls"), *[F.col(c).alias(f"__cm_{c}") for c in cols])
    gm = global_medians(d, cols, approx, prefix="__gm_")
    j = attach_one_row(d.join(cm, on=d[class_col].eqNullSafe(cm["__cls"]), how="left").drop("__cls"), gm)
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"__cm_{c}"), F.col(f"__gm_{c}"), F.lit(0.0)))
    return j.drop(*[f"__cm_{c}" for c in cols], *[f"__gm_{c}" for c in cols])


def global_medians(df: DataFrame, cols: Sequence[str], approx: bool = False, prefix: str = "") -> DataFrame:
    """One row: the exact median of each column (null when it has no data)."""
    lf = long_form(df, cols)
    med = _medians_long(lf, ["feature"], approx)
    return med.groupBy().pivot("feature", list(cols)).agg(F.first("median")).select(*[F.col(c).alias(prefix + c) for c in cols])


def global_median_fill(df: DataFrame, cols: Sequence[str], string_cols: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """AGG20 + FLT15: +-Inf/NaN -> missing; numeric missing -> global median
    (0 if the column is all missing); string missing -> 'missing'."""
    d = nonfinite_to_null(df, cols)
    j = attach_one_row(d, global_medians(d, cols, approx, prefix="__gm_"))
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"__gm_{c}"), F.lit(0.0)))
    for c in string_cols:
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit("missing")))
    return j.drop(*[f"__gm_{c}" for c in cols])


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG21: sample variance per column and whether it is exactly 0."""
    lf = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    g = lf.groupBy("feature").agg(F.var_samp("value").alias("variance"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("is_constant", (F.col("variance") == 0).cast("int"))
