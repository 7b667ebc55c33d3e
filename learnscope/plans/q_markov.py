"""Process-mining queries over the clustered-sessions fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..operators import markov as mk
from ..session import scratch_path
from ..sources import io
from . import common as C
from . import oracle_sql as O
from .registry import register

_STATES_VALUES = ", ".join(f"('{s}', {i})" for i, s in enumerate(L.STATES))
_IN = ", ".join(f"'{s}'" for s in L.STATES)
_TRANS = [
    *O.views("clustered"),
    "r AS (SELECT *, 'c' || CAST(CAST(cluster AS INTEGER) AS VARCHAR) AS state FROM clustered WHERE cluster IS NOT NULL)",
    """o AS (SELECT *, lag(state) OVER w AS prev_state, lead(state) OVER w AS next_state FROM r
         WINDOW w AS (PARTITION BY student_id, class_id ORDER BY dialog_time ASC NULLS LAST, event_id))""",
    """tr AS (SELECT student_id, class_id, event_id, 'START' AS from_state, state AS to_state FROM o WHERE prev_state IS NULL
          UNION ALL SELECT student_id, class_id, event_id, state AS from_state, coalesce(next_state, 'END') AS to_state FROM o)""",
    f"st AS (SELECT * FROM (VALUES {_STATES_VALUES}) AS t(state, idx))",
    f"""cnt AS (SELECT a.state AS from_state, b.state AS to_state, CAST(a.idx AS INTEGER) AS from_idx, CAST(b.idx AS INTEGER) AS to_idx,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n
         FROM st a CROSS JOIN st b LEFT JOIN (SELECT from_state, to_state, count(*) AS n FROM tr
           WHERE from_state IN ({_IN}) AND to_state IN ({_IN}) GROUP BY 1, 2) c ON c.from_state = a.state AND c.to_state = b.state)""",
    """pr AS (SELECT *, CASE WHEN sum(n) OVER (PARTITION BY from_state) > 0 THEN n / sum(n) OVER (PARTITION BY from_state) ELSE 0.0 END AS p FROM cnt)""",
]


def _trans(spark, sf):
    return mk.transitions(C.clustered(spark, sf))


@register("fomm_transitions", O.with_(*_TRANS) + "SELECT * FROM tr")
def fomm_transitions(spark, sf):
    """WIN5 + SRT2 + SET3 + SCL16: START / step / END transitions per sequence."""
    return _trans(spark, sf)


@register("fomm_counts", O.with_(*_TRANS) + "SELECT * FROM cnt")
def fomm_counts(spark, sf):
    """AGG32 + JOIN7 + JOIN8: dense transition counts over the 6 states
    (transitions touching c4 are skipped)."""
    return mk.transition_counts(_trans(spark, sf))


@register("fomm_probs", O.with_(*_TRANS) + "SELECT * FROM pr", floats=("p",))
def fomm_probs(spark, sf):
    """AGG33: row-normalized transition probabilities."""
    return mk.transition_probs(mk.transition_counts(_trans(spark, sf)))


_LABEL_CASE = "CASE from_state " + " ".join(f"WHEN '{s}' THEN '{L.STATE_LABELS[s]}'" for s in L.STATES) + " END"


@register("fomm_matrix_wide", O.with_(*_TRANS)
          + "SELECT from_state, from_idx, " + ", ".join(f"max(p) FILTER (WHERE to_state = '{s}') AS \"{s}\"" for s in L.STATES)
          + f", {_LABEL_CASE} AS from_label FROM pr GROUP BY from_state, from_idx",
          floats=tuple(L.STATES))
def fomm_matrix_wide(spark, sf):
    """SNK7 + SCL17: wide probability matrix with display labels."""
    return mk.matrix_wide(mk.transition_probs(mk.transition_counts(_trans(spark, sf))))


_NAMES = [L.STATE_LABELS[s] for s in L.STATES]


@register("snk_matrices", O.with_(*_TRANS) + " UNION ALL ".join(
    f"SELECT '{name}' AS matrix, {_LABEL_CASE} AS from_label, " + ", ".join(f"CAST(max({v}) FILTER (WHERE to_state = '{s}') AS DOUBLE) AS \"{L.STATE_LABELS[s]}\"" for s in L.STATES)
    + " FROM pr GROUP BY from_state" for name, v in (("count", "n"), ("probability", "p"))), floats=tuple(_NAMES))
def snk_matrices(spark, sf):
    """SNK7: count and probability matrices with labelled rows and columns,
    written as CSV and read back."""
    probs = mk.transition_probs(mk.transition_counts(_trans(spark, sf)))
    out = None
    for name, value in (("count", "n"), ("probability", "p")):
        m = mk.matrix_wide(probs, value).select("from_label", *[F.col(s).cast("double").alias(L.STATE_LABELS[s]) for s in L.STATES])
        path = scratch_path(spark, f"matrix-{name}")
        io.write_csv(m, path)
        back = spark.read.options(**io.CSV_READ).schema(m.schema).csv(path).withColumn("matrix", F.lit(name))
        out = back if out is None else out.unionByName(back)
    return out


@register("fomm_annotated", O.with_(*_TRANS)
          + "SELECT from_state, to_state, n, p, printf('%.2f', p) || chr(10) || '(' || CAST(n AS VARCHAR) || ')' AS annotation FROM pr",
          floats=("p",))
def fomm_annotated(spark, sf):
    """SCL18: heatmap cell text 'p (n)'."""
    a = mk.annotate(mk.transition_probs(mk.transition_counts(_trans(spark, sf))))
    return a.select("from_state", "to_state", "n", "p", "annotation")


@register("fomm_sequences", O.with_(*_TRANS)
          + f"""SELECT (SELECT count(*) FROM (SELECT DISTINCT student_id, class_id FROM clustered)) AS n_pairs,
                  (SELECT count(*) FROM (SELECT DISTINCT student_id, class_id FROM clustered WHERE cluster IS NOT NULL)) AS n_sequences,
                  (SELECT count(*) FROM clustered) AS n_rows, (SELECT count(*) FILTER (WHERE cluster IS NULL) FROM clustered) AS n_null_cluster,
                  (SELECT count(*) FILTER (WHERE NOT (from_state IN ({_IN}) AND to_state IN ({_IN}))) FROM tr) AS n_skipped,
                  (SELECT count(*) FROM tr) AS n_transitions""")
def fomm_sequences(spark, sf):
    """AGG31 + AGG34 + SET2: pairs, sequences and skipped transitions."""
    cl = C.clustered(spark, sf)
    return mk.sequence_summary(cl, mk.transitions(cl))
