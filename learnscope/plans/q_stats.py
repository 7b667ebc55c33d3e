"""Statistics and missing-value queries over the feature table and the dirty
feature fixture."""

from __future__ import annotations

from ..functions import lexicon as L
from ..operators import stats as st
from ..session import scratch_path
from ..sources import io
from . import common as C
from . import oracle_sql as O
from .registry import register

FEAT_IMP = [*O.features_ctes(720), *O.imputed_ctes()]
FCOLS = L.FEATURE_COLUMNS
DCOLS = ["f1", "f_const", "f_all_null_class"]


def _long(src: str, cols, keys=()) -> str:
    k = "".join(f"{c}, " for c in keys)
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


def _clean_long(src: str, cols, keys=()) -> str:
    return f"SELECT * FROM ({_long(src, cols, keys)}) WHERE value IS NOT NULL AND NOT isnan(value)"


@register("agg_feature_stats", O.with_(*FEAT_IMP, f"lf AS ({_clean_long('imp', FCOLS)})")
          + "SELECT feature, min(value) AS min, max(value) AS max, avg(value) AS mean, median(value) AS median, var_samp(value) AS variance FROM lf GROUP BY feature",
          floats=("min", "max", "mean", "median", "variance"))
def agg_feature_stats(spark, sf):
    """AGG12 + FLT10 + SNK6: min/max/mean/median/variance of every numeric
    column beside the keys, written as a table and read back."""
    f = C.raw_features(spark, sf)
    path = scratch_path(spark, "feature-stats")
    io.write_csv(st.feature_stats(f.select("student_id", "session_index", "file_name", "class_id", *FCOLS), exclude=["student_id", "session_index", "class_id"]), path)
    back = spark.read.options(**io.CSV_READ).schema("feature string, min double, max double, mean double, median double, variance double").csv(path)
    return back


@register("agg_histogram", O.with_(*FEAT_IMP, f"lf AS ({_clean_long('imp', FCOLS)})",
                                   """r0 AS (SELECT feature, min(value) AS lo0, max(value) AS hi0 FROM lf GROUP BY feature)""",
                                   """r AS (SELECT feature, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0)""",
                                   O.edges_cte("r", 50))
          + "SELECT lf.feature, bin, count(*) AS count, min(e0) AS lo, min(e1) AS hi FROM lf JOIN edges e ON e.feature = lf.feature AND value >= e0 AND (value < e1 OR bin = 49 AND value <= e1) GROUP BY lf.feature, bin",
          floats=("lo", "hi"))
def agg_histogram(spark, sf):
    """AGG14: 50-bin equal-width histograms of the raw features."""
    return st.histogram(C.raw_features(spark, sf), FCOLS, bins=L.HISTOGRAM_BINS)


@register("agg_binary_counts", O.with_(*FEAT_IMP, f"lf AS ({_clean_long('imp', FCOLS)})",
                                       "pv AS (SELECT feature, value, count(*) AS count FROM lf GROUP BY feature, value)",
                                       "bf AS (SELECT feature FROM pv GROUP BY feature HAVING count(*) <= 2 AND max(CASE WHEN value IN (0.0, 1.0) THEN 0 ELSE 1 END) = 0)")
          + "SELECT feature, CAST(value AS INTEGER) AS value, count FROM pv WHERE feature IN (SELECT feature FROM bf)")
def agg_binary_counts(spark, sf):
    """AGG13: value counts of the 0/1 features."""
    return st.binary_counts(C.raw_features(spark, sf), FCOLS)


@register("agg_describe", O.with_(*FEAT_IMP, f"lf AS ({_clean_long('imp', FCOLS)})")
          + """SELECT feature, count(*) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
                 quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, max(value) AS max
               FROM lf GROUP BY feature""",
          floats=("mean", "std", "min", "p25", "p50", "p75", "max"))
def agg_describe(spark, sf):
    """AGG24: describe() of the raw features."""
    return st.describe(C.raw_features(spark, sf), FCOLS)


@register("prj_feature_select", O.with_(*FEAT_IMP)
          + "SELECT student_id, session_index, " + ", ".join(c for c in FCOLS if c != "is_in_class_time") + " FROM imp",
          floats=("avg_qa_time_minutes", "avg_question_length", "copy_paste_score", "answer_seeking_intensity", "understanding_signal_strength"))
def prj_feature_select(spark, sf):
    """FLT9: preferred-order feature selection from a table missing one feature."""
    f = C.raw_features(spark, sf).drop("is_in_class_time")
    return st.select_features(f, FCOLS, keep=["student_id", "session_index"])


# ------------------------------------------------------------------ dirty features

_DIRTY = O.views("dirty_features")
_FIN = ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in DCOLS)


@register("prj_nonfinite_to_null", O.with_(*_DIRTY) + f"SELECT event_id, class_id, {_FIN} FROM dirty_features",
          floats=tuple(DCOLS))
def prj_nonfinite_to_null(spark, sf):
    """FLT7: NaN / +-Inf -> null."""
    return st.nonfinite_to_null(C.dirty(spark, sf), DCOLS).select("event_id", "class_id", *DCOLS)


@register("agg_class_median_fill", O.with_(*_DIRTY, f"d AS (SELECT event_id, class_id, {_FIN} FROM dirty_features)",
                                           "cm AS (SELECT class_id, " + ", ".join(f"median({c}) AS m_{c}" for c in DCOLS) + " FROM d GROUP BY class_id)",
                                           "gm AS (SELECT " + ", ".join(f"median({c}) AS g_{c}" for c in DCOLS) + " FROM d)")
          + "SELECT event_id, d.class_id, " + ", ".join(f"coalesce(d.{c}, cm.m_{c}, gm.g_{c}, 0.0) AS {c}" for c in DCOLS)
          + " FROM d LEFT JOIN cm ON d.class_id IS NOT DISTINCT FROM cm.class_id CROSS JOIN gm",
          floats=tuple(DCOLS))
def agg_class_median_fill(spark, sf):
    """AGG19: class-median fill, then global median, then 0."""
    return st.class_median_fill(C.dirty(spark, sf), DCOLS).select("event_id", "class_id", *DCOLS)


_GFILL = [*_DIRTY, f"d AS (SELECT event_id, class_id, tag, {_FIN} FROM dirty_features)",
          "gm AS (SELECT " + ", ".join(f"median({c}) AS g_{c}" for c in DCOLS) + " FROM d)",
          "g AS (SELECT event_id, class_id, coalesce(tag, 'missing') AS tag, " + ", ".join(f"coalesce(d.{c}, gm.g_{c}, 0.0) AS {c}" for c in DCOLS) + " FROM d CROSS JOIN gm)"]


@register("agg_global_median_fill", O.with_(*_GFILL) + "SELECT * FROM g", floats=tuple(DCOLS))
def agg_global_median_fill(spark, sf):
    """AGG20 + FLT15: global-median fill of the numeric columns, 'missing' for
    the text column."""
    return st.global_median_fill(C.dirty(spark, sf), DCOLS, string_cols=["tag"]).select("event_id", "class_id", "tag", *DCOLS)


@register("agg_constant_columns", O.with_(*_GFILL, f"lf AS ({_clean_long('g', DCOLS)})")
          + "SELECT feature, var_samp(value) AS variance, count(*) AS n, CAST(var_samp(value) = 0 AS INTEGER) AS is_constant FROM lf GROUP BY feature",
          floats=("variance",))
def agg_constant_columns(spark, sf):
    """AGG21: constant-column detection after the global fill."""
    return st.constant_columns(st.global_median_fill(C.dirty(spark, sf), DCOLS), DCOLS)


_AUD = ["f1", "f_all_null_class"]


@register("agg_nonfinite_audit", O.with_(*_DIRTY, f"lf AS ({_long('dirty_features', _AUD, ['event_id'])})")
          + """SELECT feature, count(*) FILTER (WHERE isinf(value)) AS inf_count, count(*) FILTER (WHERE isnan(value)) AS nan_count,
                 count(*) FILTER (WHERE value IS NULL) AS null_count, min(event_id) FILTER (WHERE isinf(value) OR isnan(value)) AS first_nonfinite_key,
                 min(value) FILTER (WHERE isfinite(value)) AS finite_min, max(value) FILTER (WHERE isfinite(value)) AS finite_max,
                 avg(value) FILTER (WHERE isfinite(value)) AS finite_mean, stddev_samp(value) FILTER (WHERE isfinite(value)) AS finite_std
               FROM lf GROUP BY feature""",
          floats=("finite_min", "finite_max", "finite_mean", "finite_std"))
def agg_nonfinite_audit(spark, sf):
    """AGG22: non-finite audit per feature."""
    return st.nonfinite_audit(C.dirty(spark, sf), _AUD, "event_id")


@register("agg_nan_profile", O.with_(*_DIRTY, f"lf AS ({_long('dirty_features', _AUD, ['class_id'])})",
                                     """g AS (SELECT feature, class_id, count(*) AS n, count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS n_missing,
                                        avg(value) FILTER (WHERE value IS NOT NULL AND NOT isnan(value)) AS nan_mean FROM lf GROUP BY feature, class_id)""")
          + "SELECT *, CASE WHEN n_missing = n THEN 'all_nan' WHEN n_missing > 0 THEN 'partial_nan' ELSE 'complete' END AS status FROM g",
          floats=("nan_mean",))
def agg_nan_profile(spark, sf):
    """AGG23: NaN profile per (feature, class)."""
    return st.nan_profile(C.dirty(spark, sf), _AUD, "class_id")
