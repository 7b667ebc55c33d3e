"""Inputs shared by the registered queries: fixture views and the stages
built on them. Each call builds a fresh plan over the given scale-factor
directory; the only materialization is the accepted-session checkpoint inside
``features.session_features`` (to the shared checkpoint folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures as fx
from ..operators import features as fe
from ..operators import segment as sg

FEATURE_GAP = 720  # feature and ML queries use long sessions (see FIXTURES.md)


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_view(spark, sf, "turns")


def classes(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_view(spark, sf, "classes")


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_view(spark, sf, "schedule")


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_view(spark, sf, "clustered")


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return fx.load_view(spark, sf, "dirty_features")


def sessions(spark: SparkSession, sf: str, gap=15, entry=True) -> DataFrame:
    return sg.segment(turns(spark, sf), gap_minutes=gap, split_on_entry=entry)


def measured_sessions(spark: SparkSession, sf: str, gap=FEATURE_GAP, keep="edges", lexicon=None) -> DataFrame:
    """Segmented turns whose texts were measured before the segmentation."""
    return sg.segment(fe.measure_turns(turns(spark, sf), keep, lexicon), gap_minutes=gap, split_on_entry=True)


def extracted(spark: SparkSession, sf: str, gap=FEATURE_GAP, allowlist=None) -> DataFrame:
    return fe.extract(measured_sessions(spark, sf, gap), classes(spark, sf), schedule(spark, sf), allowlist)


def raw_features(spark: SparkSession, sf: str, gap=FEATURE_GAP, columns=None) -> DataFrame:
    """ok sessions after single-turn imputation, before log1p (``columns``: only
    these features)."""
    return fe.session_features(measured_sessions(spark, sf, gap), classes(spark, sf), schedule(spark, sf), log_transform=False, columns=columns)


def logged_features(spark: SparkSession, sf: str, gap=FEATURE_GAP) -> DataFrame:
    return fe.log1p_features(raw_features(spark, sf, gap))
