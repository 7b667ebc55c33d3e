"""Feature queries: scalar text functions, per-session features, reject
cascade, joins to class dimensions, imputation and log1p."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import measures as M
from ..functions import text as X
from ..operators import features as fe
from ..session import scratch_path
from ..sources import io
from . import common as C
from . import oracle_sql as O
from .registry import register

KEYS = ["student_id", "session_index"]
FEAT = O.features_ctes(720)

# ------------------------------------------------------------------ scalars (per turn)


@register("scl_question_length", O.with_(*O.views("turns"))
          + f"SELECT turn_id, {O.question_length('question_text')} AS question_length FROM turns")
def scl_question_length(spark, sf):
    """SCL1: cleaned question length per turn."""
    return X.with_question_length(C.turns(spark, sf), "question_text", "question_length").select("turn_id", "question_length")


@register("scl_normalize", O.with_(*O.views("turns"))
          + f"SELECT turn_id, {O.normalize('question_text')} AS normalized, {O.normalize('ai_response')} AS normalized_reply FROM turns")
def scl_normalize(spark, sf):
    """SCL2: full-width -> half-width, whitespace removed."""
    t = C.turns(spark, sf)
    return t.select("turn_id", M.per_batch(M.normalized_texts, "string", "question_text").alias("normalized"), M.per_batch(M.normalized_texts, "string", "ai_response").alias("normalized_reply"))


@register("scl_keyword_count", O.with_(*O.views("turns"), f"n AS (SELECT turn_id, {O.normalize('question_text')} AS s FROM turns)")
          + f"""SELECT turn_id, CAST({O.phrases_count('s', L.COPY_KEYWORDS)} AS INTEGER) AS copy_phrases,
                 CAST({O.phrases_count('s', L.ANSWER_SEEKING_KEYWORDS_PROMPT)} AS INTEGER) AS answer_phrases,
                 CAST({O.phrases_count('s', L.UNDERSTANDING_KEYWORDS_PROMPT)} AS INTEGER) AS understanding_phrases,
                 CAST({O.phrase_count('s', '答案')} AS INTEGER) AS n_answer_word FROM n""")
def scl_keyword_count(spark, sf):
    """SCL3 (+UDF2 lexicon): non-overlapping phrase counts on normalized text."""
    lists = {"copy_phrases": L.COPY_KEYWORDS, "answer_phrases": L.ANSWER_SEEKING_KEYWORDS_PROMPT,
             "understanding_phrases": L.UNDERSTANDING_KEYWORDS_PROMPT, "n_answer_word": ["答案"]}
    count = M.phrase_counter(list(lists.values()))
    n = M.per_text(lambda s: count(M.normalized(s)), "struct<" + ",".join(f"{c}:int" for c in lists) + ">", "question_text")
    return C.turns(spark, sf).select("turn_id", n.alias("n")).select("turn_id", "n.*")


@register("scl_pattern_count", O.with_(*O.views("turns"))
          + f"""SELECT turn_id, CAST({O.patterns_count('question_text', L.NON_NATURAL_PATTERNS)} AS INTEGER) AS copy_patterns,
                 CAST({O.patterns_count('question_text', L.HYPOTHETICAL_PATTERNS)} AS INTEGER) AS hypothetical_patterns,
                 CAST(CASE WHEN {O.has_image("coalesce(question_text, '')")} THEN 1 ELSE 0 END AS INTEGER) AS has_image FROM turns""")
def scl_pattern_count(spark, sf):
    """SCL4-5: regex match counts on raw text and the image predicate."""
    def counts(s):
        s = s or ""
        return M.patterns_found(s, M.COPY_PATTERNS), M.patterns_found(s, M.HYPOTHETICAL), int(M.has_image(s))

    n = M.per_text(counts, "struct<copy_patterns:int,hypothetical_patterns:int,has_image:int>", "question_text")
    return C.turns(spark, sf).select("turn_id", n.alias("n")).select("turn_id", "n.*")


# ------------------------------------------------------------------ per-session features (all sessions)

_SESS = [*O.views("turns"), O.seg_cte("seg", gap=720, entry=True), O.summary_cte("seg"), O.behavioral_cte("summary")]


def _summary(spark, sf, keep="none"):
    return fe.behavioral(fe.session_summary(C.measured_sessions(spark, sf, 720, keep), with_text=keep == "text"))


@register("feat_behavioral", O.with_(*_SESS)
          + "SELECT student_id, session_index, CAST(qa_turns AS INTEGER) AS qa_turns, avg_qa_time_minutes, avg_question_length FROM behav",
          floats=("avg_qa_time_minutes", "avg_question_length"))
def feat_behavioral(spark, sf):
    """AGG3-5: qa_turns, avg_qa_time_minutes, avg_question_length per session."""
    return _summary(spark, sf).select(*KEYS, F.col("qa_turns").cast("int").alias("qa_turns"), "avg_qa_time_minutes", "avg_question_length")


@register("feat_flags", O.with_(*_SESS)
          + "SELECT student_id, session_index, CAST(has_image AS INTEGER) AS has_image, CAST(is_confusion_entry AS INTEGER) AS is_confusion_entry, strftime(t_min, '%Y-%m-%d %H:%M:%S') AS dialog_time FROM behav")
def feat_flags(spark, sf):
    """AGG6-8: image flag, confusion-entry flag, session start."""
    s = _summary(spark, sf)
    return s.select(*KEYS, F.col("has_image").cast("int").alias("has_image"), F.col("is_confusion_entry").cast("int").alias("is_confusion_entry"),
                    F.date_format("t_min", "yyyy-MM-dd HH:mm:ss").alias("dialog_time"))


@register("feat_pooled_text", O.with_(*_SESS)
          + "SELECT student_id, session_index, CAST(length(pooled_prompts) AS INTEGER) AS pooled_chars, md5(pooled_prompts) AS pooled_md5, md5(substr(first_ai_reply, 1, 100)) AS first_reply_md5 FROM behav")
def feat_pooled_text(spark, sf):
    """AGG10-11: ordered pooled prompts and the first AI reply."""
    s = _summary(spark, sf, "text")
    return s.select(*KEYS, F.length("pooled_prompts").alias("pooled_chars"), F.md5("pooled_prompts").alias("pooled_md5"), F.md5("first_ai_reply").alias("first_reply_md5"))


_SIG = [*_SESS, O.signals_cte("behav")]


def _signals(spark, sf):
    return fe.text_signals(fe.behavioral(fe.session_signals(C.measured_sessions(spark, sf, 720))))


@register("feat_copy_paste", O.with_(*_SIG)
          + "SELECT student_id, session_index, copy_paste_score, CAST(copy_paste_score > 0 AS INTEGER) AS is_copy_paste, CAST(avg_raw_length > 500 AS INTEGER) AS long_question FROM sig",
          floats=("copy_paste_score",))
def feat_copy_paste(spark, sf):
    """SCL6 + AGG9: copy_paste_score and flag per session."""
    s = _signals(spark, sf)
    return s.select(*KEYS, "copy_paste_score", "is_copy_paste", (F.col("avg_raw_length") > 500).cast("int").alias("long_question"))


@register("feat_answer_seeking", O.with_(*_SIG) + "SELECT student_id, session_index, answer_seeking_intensity FROM sig",
          floats=("answer_seeking_intensity",))
def feat_answer_seeking(spark, sf):
    """SCL7: answer_seeking_intensity per session."""
    return _signals(spark, sf).select(*KEYS, "answer_seeking_intensity")


@register("feat_understanding", O.with_(*_SIG) + "SELECT student_id, session_index, understanding_signal_strength FROM sig",
          floats=("understanding_signal_strength",))
def feat_understanding(spark, sf):
    """SCL8: understanding_signal_strength per session."""
    return _signals(spark, sf).select(*KEYS, "understanding_signal_strength")


#: a caller's own lists in place of all six
_LEXICON = {
    "copy": ["the", "答案", "las"], "copy_patterns": [r"[0-9]{4,}", r"[#*$%&]{3}"], "answer_prompt": ["and", "and", "which"],
    "answer_reply": ["of", "re"], "understanding": ["why", "tion", "为什么"], "hypothetical": [r"if[^\n]*then", r"[.] "],
}


@register("feat_lexicon_override", O.with_(*_SESS, O.signals_cte("behav", lexicon=_LEXICON))
          + "SELECT student_id, session_index, copy_paste_score, answer_seeking_intensity, understanding_signal_strength FROM sig",
          floats=("copy_paste_score", "answer_seeking_intensity", "understanding_signal_strength"))
def feat_lexicon_override(spark, sf):
    """UDF2: the three text signals under a caller's own phrases and patterns."""
    s = fe.text_signals(fe.behavioral(fe.session_signals(C.measured_sessions(spark, sf, 720, lexicon=_LEXICON), _LEXICON)), lexicon=_LEXICON)
    return s.select(*KEYS, "copy_paste_score", "answer_seeking_intensity", "understanding_signal_strength")


# ------------------------------------------------------------------ dimensions, reject cascade


@register("join_class_window", O.with_(*O.views("classes"), O.windows_cte("classes"))
          + "SELECT class_id, strftime(course_start, '%Y-%m-%d %H:%M:%S') AS course_start, strftime(course_end, '%Y-%m-%d %H:%M:%S') AS course_end FROM windows")
def join_class_window(spark, sf):
    """JOIN1 dimension: first class row wins (by ord)."""
    w = fe.class_windows(C.classes(spark, sf))
    return w.select("class_id", F.date_format("course_start", "yyyy-MM-dd HH:mm:ss").alias("course_start"),
                    F.date_format("course_end", "yyyy-MM-dd HH:mm:ss").alias("course_end"))


@register("flt_reject_reason", O.with_(*FEAT) + "SELECT student_id, session_index, class_id, qa_turns, reject_reason FROM feat")
def flt_reject_reason(spark, sf):
    """FLT4-5 + JOIN1 + SNK4: reject reason of every session."""
    return C.extracted(spark, sf).select(*KEYS, "class_id", "qa_turns", "reject_reason")


_FILE_REJECTS = """SELECT n_nationkey AS file, CASE n_nationkey % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'missing_columns' WHEN 2 THEN 'missing_class' ELSE 'missing_student' END AS reason FROM nation"""


@register("agg_reject_stats", O.with_(*FEAT, f"rejects AS ({_FILE_REJECTS})", "every AS (SELECT reject_reason AS r FROM feat UNION ALL SELECT 'file_' || reason FROM rejects)")
          + """SELECT *, processed / total AS success_ratio, out_of_range / total AS out_of_range_ratio,
    (out_of_range + failed) / total AS fail_ratio, (total - processed) / total AS reject_ratio FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE r = 'ok') AS processed,
    count(*) FILTER (WHERE r = 'out_of_range') AS out_of_range, count(*) FILTER (WHERE r = 'no_class') AS no_class,
    count(*) FILTER (WHERE r = 'bad_window') AS bad_window, count(*) FILTER (WHERE r = 'invalid_time') AS invalid_time,
    count(*) FILTER (WHERE r = 'zero_day_window') AS zero_day_window,
    count(*) FILTER (WHERE r = 'filtered_by_class_info') AS filtered_by_class_info,
    count(*) FILTER (WHERE r = 'file_empty') AS empty_files, count(*) FILTER (WHERE r = 'file_missing_columns') AS missing_columns,
    count(*) FILTER (WHERE r = 'file_missing_class') AS failed, count(*) FILTER (WHERE r = 'file_missing_student') AS missing_student FROM every)""",
          floats=("success_ratio", "out_of_range_ratio", "fail_ratio", "reject_ratio"))
def agg_reject_stats(spark, sf):
    """AGG18 + SNK3: reject counters and ratios of sessions and files, written
    as JSON and read back."""
    from .. import fixtures as fx

    fx.register_tables(spark, sf, ["nation"])
    stats = fe.reject_stats(C.extracted(spark, sf), spark.sql(_FILE_REJECTS))
    path = scratch_path(spark, "reject-stats")
    io.write_json(stats, path)
    return spark.read.schema(stats.schema).json(path)


_ALLOW_SQL = "SELECT CAST(n_nationkey AS BIGINT) AS class_id FROM nation WHERE n_nationkey % 2 = 0"


@register("join_class_allowlist", O.with_(f"allow AS ({_ALLOW_SQL})", *O.features_ctes(720, allow="allow"))
          + "SELECT student_id, session_index, class_id, reject_reason FROM feat")
def join_class_allowlist(spark, sf):
    """JOIN3: class allowlist (even class ids) applied in the reject cascade."""
    from .. import fixtures as fx

    fx.register_tables(spark, sf, ["nation"])
    allow = spark.sql(_ALLOW_SQL)
    return C.extracted(spark, sf, allowlist=allow).select(*KEYS, "class_id", "reject_reason")


@register("join_in_class", O.with_(*FEAT[:3], O.seg_cte("seg", gap=720, entry=True), O.summary_cte("seg"), O.inclass_cte("seg", "summary"))
          + """SELECT s.student_id, s.session_index, CAST(coalesce(i.is_in_class_time, 0) AS INTEGER) AS is_in_class_time
               FROM summary s LEFT JOIN inclass i ON s.student_id = i.student_id AND s.session_index = i.session_index""")
def join_in_class(spark, sf):
    """JOIN2: interval join of turns to class slots (session class), flag per session."""
    seg = C.sessions(spark, sf, 720)
    marked = fe.mark_in_class(seg, C.schedule(spark, sf), "session_class_id")
    return marked.groupBy(*KEYS).agg(F.max("in_slot").cast("int").alias("is_in_class_time"))


@register("feat_temporal", O.with_(*FEAT)
          + "SELECT student_id, session_index, dialog_time, course_progress_ratio, is_exam_week, day_period, is_in_class_time FROM feat WHERE reject_reason = 'ok'")
def feat_temporal(spark, sf):
    """SCL9-11 + JOIN2: calendar features of accepted sessions."""
    e = C.extracted(spark, sf).filter(F.col("reject_reason") == "ok")
    return e.select(*KEYS, "dialog_time", "course_progress_ratio", "is_exam_week", "day_period", "is_in_class_time")


# ------------------------------------------------------------------ post-processing


@register("agg_single_turn_impute", O.with_(*FEAT, *O.imputed_ctes())
          + "SELECT student_id, session_index, class_id, qa_turns, avg_qa_time_minutes FROM imp",
          floats=("avg_qa_time_minutes",))
def agg_single_turn_impute(spark, sf):
    """AGG15-17 + JOIN4 + FLT11/14: single-turn duration imputation."""
    return C.raw_features(spark, sf, columns=[]).select(*KEYS, "class_id", "qa_turns", "avg_qa_time_minutes")


@register("prj_log1p", O.with_(*FEAT, *O.imputed_ctes(), O.logged_cte())
          + "SELECT student_id, session_index, " + ", ".join(L.LOG_FEATURES) + " FROM logged",
          floats=tuple(L.LOG_FEATURES))
def prj_log1p(spark, sf):
    """FLT8: log1p of the six skewed features."""
    return C.logged_features(spark, sf).select(*KEYS, *L.LOG_FEATURES)


@register("prj_finite_or_zero", O.with_(*O.views("dirty_features"))
          + """SELECT event_id, CASE WHEN isfinite(f1) THEN f1 ELSE 0.0 END AS f1,
                 CASE WHEN isfinite(f_all_null_class) THEN f_all_null_class ELSE 0.0 END AS f_all_null_class,
                 CAST(coalesce(TRY_CAST(CAST(class_id AS VARCHAR) AS DOUBLE), 0) AS DOUBLE) AS class_num FROM dirty_features""",
          floats=("f1", "f_all_null_class", "class_num"))
def prj_finite_or_zero(spark, sf):
    """FLT6 + FLT14: non-finite -> 0.0; numeric coercion with 0 default."""
    d = C.dirty(spark, sf).withColumn("class_num", F.col("class_id"))
    d = fe.coerce_numeric(d, ["class_num"], "double")
    return fe.finite_or_zero(d, ["f1", "f_all_null_class"]).select("event_id", "f1", "f_all_null_class", "class_num")


@register("flt_high_understanding", O.with_(*FEAT, *O.imputed_ctes())
          + "SELECT threshold, student_id, session_index, understanding_signal_strength, printf('score_%.2f_%s', understanding_signal_strength, file_name) AS tagged_name "
            "FROM imp CROSS JOIN (VALUES (1), (10)) AS t(threshold) WHERE understanding_signal_strength > threshold",
          floats=("understanding_signal_strength",))
def flt_high_understanding(spark, sf):
    """SNK5: sessions with a raw understanding score above 1 and above 10 (the
    default), score-tagged names."""
    f = C.raw_features(spark, sf, columns=["understanding_signal_strength"])
    some, high = fe.high_understanding(f, 1), fe.high_understanding(f)
    h = some.withColumn("threshold", F.lit(1)).unionByName(high.withColumn("threshold", F.lit(10)))
    return h.select("threshold", *KEYS, "understanding_signal_strength", "tagged_name")
