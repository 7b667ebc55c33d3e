"""Flagship query: how do learners move between session types?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import lexicon as L
from ..operators import features as fe
from ..operators import segment as sg
from . import common as C
from .stages import cluster_matrix, prepare_matrix, transition_model


def flagship(spark: SparkSession, sf: str, gap_minutes: float = 15, n_init: int = L.N_INIT, k: int | None = None) -> DataFrame:
    """Turns -> cleaned turns -> sessions (entry change / 15-minute gap) -> session features ->
    K-Means session types (elbow K) -> Markov transition probabilities."""
    sessions = sg.segment(sg.clean_turns(C.turns(spark, sf)), gap_minutes=gap_minutes)
    feats = fe.session_features(sessions, C.classes(spark, sf), C.schedule(spark, sf))
    res = cluster_matrix(prepare_matrix(feats), n_init=n_init, stability_iterations=0, k=k)
    return transition_model(res.labels, res.k).select("from_state", "to_state", "n", "p")
